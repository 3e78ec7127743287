"""SentencePiece encoding and decoding by a Viterbi search that words share by prefix.

A text is marked as the model asks (a leading space; U+2581, which stands for a space
in the model, is a space here in texts and pieces, so that most strings are ASCII) and cut
into units that no piece of the vocabulary crosses: a run of marks with the word
behind it, a line break.  The distinct units of a stretch of text are sorted,
which lays them out as a trie in depth-first order; going from one unit to the
next keeps the forward scores of their common prefix and computes only what
follows.

Two kinds of model exist.  In a unigram model the forward score of a prefix is
its best sum of piece scores.  In a byte-pair model (the given vocabulary) the
scores are merge ranks, and the pieces that merging yields are not those of the
best sum; there the forward state of a prefix is the last piece that merging it
yields.  That piece is the longest one that ends there and that merging leaves
apart from the last piece before it, so it too follows from shorter prefixes.

Characters outside the vocabulary become their bytes' pieces.  Decoding joins
pieces and bytes and drops the leading mark.  A null text has null tokens, an
empty one none.  U+2581 in a text is read as a space, as the model does, so only
such texts don't come back unchanged.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.llm.common import add_columns, table, worker_keeps

MODEL = os.path.join(os.environ.get("TOKENIZER_DIR", "/opt/tokenizers"), "piece_bpe_32k.model")
MARK = "▁"
#: characters of text whose distinct units are sorted together
STRETCH = 1 << 20
#: units whose tokens a worker keeps for later texts (twice as many for a while), and the longest that it keeps
UNITS_KEPT, LONGEST_KEPT = 100_000, 40
#: pairs of pieces whose merging a worker remembers
PAIRS_KEPT = 300_000

_LETTER, _STOP = "[A-Za-zÀ-ɏ]", "[.,!?;:]"
_UNIT = " *[^ \n]+| +|\n"
# also cuts between a letter and a stop, where no piece of the vocabulary has both
_UNIT_OR_STOP = f" *[^ \n.,!?;:]*{_LETTER}(?={_STOP})|{_UNIT}"
_UNIGRAM, _BPE = 1, 2


def merge(score: dict[str, float], symbols: list[str]) -> list[str]:
    """Byte-pair merging: the best scored pair first, the leftmost among equals."""
    while len(symbols) > 1:
        best, at = None, -1
        for i in range(len(symbols) - 1):
            own = score.get(symbols[i] + symbols[i + 1])
            if own is not None and (best is None or own > best):
                best, at = own, i
        if best is None:
            break
        symbols[at:at + 2] = [symbols[at] + symbols[at + 1]]
    return symbols


class Vocabulary:
    """Pieces, scores and byte pieces of a model file; plain data that goes to the executors."""

    def __init__(self, path: str = MODEL):
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.name != "identity" or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models that leave texts as they are give them back unchanged")
        self.kind = model.trainer_spec.model_type
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError(f"model type {self.kind} is neither unigram nor byte pair")
        self.prefix = " " if model.normalizer_spec.add_dummy_prefix else ""
        processor = SentencePieceProcessor(model_file=path)
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}  # by piece, with U+2581 as a space
        self.bytes: list[bytes] = []  # of each id, with U+2581 as a space
        self.byte_id = [0] * 256
        for i in range(processor.get_piece_size()):
            piece = processor.id_to_piece(i)
            if processor.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif processor.is_control(i) or processor.is_unknown(i) or processor.is_unused(i):
                self.bytes.append(b"")
            else:
                own = piece.replace(MARK, " ")
                self.bytes.append(own.encode())
                if " " not in piece:  # one with a space of its own fits no marked text
                    self.id[own], self.score[own] = i, processor.get_score(i)
        if any("\n" in p or re.search("[^ ] ", p) for p in self.id):
            raise ValueError("a piece crosses a line break or the start of a word")
        self.unit = _UNIT if any(re.search(_LETTER + _STOP, p) for p in self.id) else _UNIT_OR_STOP
        # pieces by character; "" marks the end of one that merging its own characters yields
        self.trie: dict = {}
        for piece in self.id:
            if self.kind == _UNIGRAM or len(merge(self.score, list(piece))) == 1:
                node = self.trie
                for character in piece:
                    node = node.setdefault(character, {})
                node[""] = piece


class PrefixEncoder:
    """Encodes sorted units, reusing what it knows of the prefix shared with the unit before."""

    def __init__(self, vocabulary: Vocabulary, apart: dict[tuple[str, str], bool]):
        self.v, self.apart = vocabulary, apart
        self.unit = ""
        # by prefix length: the last piece; the forward score; the places where a piece may have begun
        self.last: list[str] = [""]
        self.total: list[float] = [0.0]
        self.open: list[list[tuple[int, dict]]] = [[]]

    def encode(self, unit: str) -> tuple[int, ...]:
        shared, before = 0, self.unit
        for a, b in zip(unit, before):
            if a != b:
                break
            shared += 1
        del self.last[shared + 1:], self.total[shared + 1:], self.open[shared + 1:]
        choose, trie, opened = self._merged if self.v.kind == _BPE else self._best, self.v.trie, self.open[shared]
        for end in range(shared, len(unit)):
            character = unit[end]
            opened = [(begin, child) for begin, node in opened if (child := node.get(character))]
            if first := trie.get(character):
                opened.append((end, first))
            self.open.append(opened)
            choose(character, opened)
        self.unit = unit
        return self._ids(len(unit))

    def _ids(self, end: int) -> tuple[int, ...]:
        out, known, last = [], self.v.id, self.last
        while end:
            piece = last[end]
            if piece in known:
                out.append(known[piece])
            else:
                out.extend(self.v.byte_id[b] for b in reversed(piece.replace(" ", MARK).encode()))
            end -= len(piece)
        return tuple(reversed(out))

    def _best(self, character: str, opened: list[tuple[int, dict]]) -> None:
        """Forward step of a unigram model: the best sum of scores."""
        best, score = character, self.total[-1] - 1e6  # a character outside the vocabulary
        for begin, node in opened:
            piece = node.get("")
            if piece and self.total[begin] + self.v.score[piece] > score:
                best, score = piece, self.total[begin] + self.v.score[piece]
        self.last.append(best)
        self.total.append(score)

    def _merged(self, character: str, opened: list[tuple[int, dict]]) -> None:
        """Forward step of a byte-pair model: the last piece that merging the prefix yields."""
        last, apart = self.last, self.apart
        for begin, node in opened:  # the longest first
            piece = node.get("")
            if piece:
                if not begin:
                    last.append(piece)
                    return
                stay = apart.get((last[begin], piece))
                if stay is None:
                    if len(apart) > PAIRS_KEPT:
                        apart.clear()
                    stay = apart[last[begin], piece] = merge(self.v.score, list(last[begin] + piece)) == [last[begin], piece]
                if stay:
                    last.append(piece)
                    return
        last.append(character)


class Encoder:
    """Token numbers of whole texts; keeps those of short units for the texts that follow."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        # by unit: its token numbers as bytes of 32-bit integers
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.apart: dict[tuple[str, str], bool] = {}
        self.units = re.compile(vocabulary.unit).findall

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        begin = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= STRETCH or i + 1 == len(texts):
                out.extend(self._stretch(texts[begin:i + 1]))
                begin, size = i + 1, 0
        return out

    def _stretch(self, texts: list[str]) -> list[np.ndarray]:
        units = [self.units(self.v.prefix + t.replace(MARK, " ")) if t else [] for t in texts]
        distinct = set().union(*units)
        if len(self.known) > UNITS_KEPT:
            self.known, self.earlier = {}, self.known
        known, earlier = self.known, self.earlier
        fresh = distinct.difference(known)
        for unit in fresh.intersection(earlier):
            known[unit] = earlier[unit]
        encoder, long = PrefixEncoder(self.v, self.apart), {}
        for unit in sorted(fresh.difference(earlier)):
            (known if len(unit) <= LONGEST_KEPT else long)[unit] = array("i", encoder.encode(unit)).tobytes()
        order = {unit: i for i, unit in enumerate(distinct)}
        tokens = [known[unit] if unit in known else long[unit] for unit in distinct]
        size = np.fromiter(map(len, tokens), np.int64, len(tokens)) // 4
        flat = np.frombuffer(b"".join(tokens), np.int32)
        start = np.cumsum(size) - size
        out = []
        for own in units:
            which = np.fromiter(map(order.__getitem__, own), np.int64, len(own))
            n = size[which]
            end = np.cumsum(n)
            at = np.repeat(start[which] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)
            out.append(flat[at])
        return out


def worker_encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this Python worker, with what it keeps from earlier tasks with the same (broadcast) vocabulary."""
    return worker_keeps(vocabulary, Encoder)


def decode(vocabulary: Vocabulary, tokens) -> str:
    """The text of token numbers."""
    text = b"".join([vocabulary.bytes[t] for t in tokens]).decode("utf-8", "replace")
    return text[1:] if vocabulary.prefix and text.startswith(" ") else text


def encode_texts(df: DataFrame, model: str = MODEL, text: str = "text", check: bool = True) -> DataFrame:
    """Every row with ``sp_tokens`` and, with ``check``, ``sp_same``: whether decoding gives the text back."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(model))
    fields = [T.StructField("sp_tokens", T.ArrayType(T.IntegerType()))] + [T.StructField("sp_same", T.BooleanType())] * check

    def make():
        encoder = worker_encoder(vocabulary.value)

        def compute(batch: pa.RecordBatch) -> list[pa.Array]:
            texts = batch.column(text).to_pylist()
            tokens = encoder([t or "" for t in texts])
            size = np.array([len(t) for t in tokens], np.int64)
            offsets = pa.array(np.concatenate(([0], np.cumsum(size))).astype(np.int32), pa.int32(),
                               mask=np.array([t is None for t in texts] + [False]))
            flat = np.concatenate(tokens) if tokens else np.empty(0, np.int32)
            out = [pa.ListArray.from_arrays(offsets, pa.array(flat, pa.int32()))]
            if check:
                same = [None if t is None else decode(encoder.v, ids.tolist()) == t for t, ids in zip(texts, tokens)]
                out.append(pa.array(same, pa.bool_()))
            return out

        return compute

    return add_columns(df, fields, make)


def decode_tokens(df: DataFrame, model: str = MODEL, tokens: str = "tokens") -> DataFrame:
    """Every row with ``sp_text``, the text of its token numbers (null for null)."""
    vocabulary = df.sparkSession.sparkContext.broadcast(Vocabulary(model))

    def make():
        v = vocabulary.value
        return lambda batch: [pa.array([None if t is None else decode(v, t) for t in batch.column(tokens).to_pylist()], pa.string())]

    return add_columns(df, [T.StructField("sp_text", T.StringType())], make)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its token numbers, how many, and whether decoding gives the whole text back."""
    docs = encode_texts(table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", F.coalesce(F.size("sp_tokens"), F.lit(0)).cast("long").alias("n_tokens"),
                       F.col("sp_tokens").alias("tokens"), F.col("sp_same").alias("round_trip"))
