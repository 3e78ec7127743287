"""Secret scan in DataFrame expressions: fixed patterns, and sliding-window entropy over candidate strings.

Base kinds are found leftmost first and without overlaps, each kind by itself;
matches that miss the kind's condition are dropped.  Positions come from the
lengths of the matches and of the text between them, in code points.

Entropy spans: a candidate is a run of 20 or more characters of the base-64 or
URL-safe alphabet; within it each character class has its own runs (hexadecimal
digits; all characters of the alphabet) and its own limit.  A window of 20
characters moves over a run; the counts c of its characters and the sum of
c*log2(c) change by the character that enters and the one that leaves, and
give the window's Shannon entropy.  Windows at or above the limit are merged to
spans.  Candidates on the allow list (UUIDs, text without digits or without
letters, ascending alphabets) and spans inside a base match are left out.

Null and empty texts have no spans.  Very long texts are scanned whole.  Equal
rows get equal results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.llm.common import table

# fixed values of the contract: kinds, their patterns and conditions
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{24,}"  # the same runs as [0-9a-f]+ of 24 or more
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = "[A-Za-z0-9+/_=-]{20,}"
#: characters of a window, and the least entropy in bits of each class's windows
WINDOW = 20
CLASSES = (("[0-9a-f]{20,}|[0-9A-F]{20,}", 3.05), ("[A-Za-z0-9+/_=-]{20,}", 3.95))
ALLOWED = ("[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
           "[^0-9]*", "[^A-Za-z]*", ".*(?i:0123456789abcdef|abcdefghijklmnopqrstuvwxyz).*")

_SPAN = "array<struct<start:int,kind:int,end:int>>"
#: spans gathered at once before they join the earlier ones
BLOCK = 512
#: the alphabet lies between these codes; a count takes so many bits (up to 31, and a window has 20 characters), a number holds so many counts
FIRST, LAST, BITS, FIELDS = ord("+"), ord("z"), 5, 12
#: whole units of entropy sums
UNIT = 1 << 40


def _let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _collect(items: Column, zero: Column, step) -> Column:
    """The spans that a fold over ``items`` gives; ``step(state, item)`` is a struct of the next ``state`` and the spans to ``add``.

    Spans are gathered block by block, so appending does not copy all earlier ones each time.
    """
    none = F.array().cast(_SPAN)

    def one(acc: Column, x: Column) -> Column:
        return _let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.when(
            F.size(r["add"]) > 0, F.concat(acc["out"], r["add"])).otherwise(acc["out"]).alias("out")))

    def block(every: Column, acc: Column, at: Column) -> Column:
        inner = F.aggregate(F.slice(every, at + 1, F.lit(BLOCK)), F.struct(acc["state"].alias("state"), none.alias("out")), one)
        return _let(inner, lambda r: F.struct(r["state"].alias("state"), F.when(
            F.size(r["out"]) > 0, F.concat(acc["out"], r["out"])).otherwise(acc["out"]).alias("out")))

    return _let(items, lambda every: F.when(F.size(every) > 0, F.aggregate(
        F.sequence(F.lit(0), F.size(every) - 1, F.lit(BLOCK)), F.struct(zero.alias("state"), none.alias("out")),
        lambda acc, at: block(every, acc, at), lambda acc: acc["out"])).otherwise(none))


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _positions(text: Column, pattern: str, matches: Column, kind: int) -> Column:
    """Spans of all matches of the pattern, from the lengths of matches and gaps."""
    gaps = F.split(text, pattern, -1)
    lengths = F.zip_with(gaps, matches, lambda gap, match: F.struct(
        F.coalesce(F.char_length(gap), F.lit(0)).alias("gap"), F.char_length(match).alias("match")))
    # the last gap has no match
    spans = _collect(F.filter(lengths, lambda x: x["match"].isNotNull()), F.lit(0), lambda at, x: F.struct(
        (at + x["gap"] + x["match"]).alias("state"), F.array(_span(at + x["gap"], kind, at + x["gap"] + x["match"])).alias("add")))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(_SPAN))


def _windows(run: Column, begin: Column, least: float) -> Column:
    """Merged windows of a run of characters whose entropy reaches ``least``; ``begin`` is the run's place.

    The counts of a window's characters are fields of ``BITS`` bits in a few numbers, changed by the character
    that enters and the one that leaves; so is the sum of c*log2(c), in whole units of 1 / ``UNIT``.
    """
    weight = [round(c * math.log2(c) * UNIT) if c else 0 for c in range(WINDOW + 2)]
    rise = F.array(*[F.lit(after - before).cast("long") for before, after in zip(weight, weight[1:])])  # from c to c + 1
    limit = F.lit(round((WINDOW * (math.log2(WINDOW) - least) + 1e-9) * UNIT)).cast("long")
    numbers = (LAST - FIRST) // FIELDS + 1
    add = lambda code, j: F.when(code["number"] == j, code["one"]).otherwise(F.lit(0).cast("long"))

    def coded(x: Column) -> Column:
        """Which number and which bits of it count a character, and a count of one there."""
        code = F.ascii(x) - FIRST
        return _let(F.struct(F.call_function("div", code, F.lit(FIELDS)).cast("int").alias("number"), (code % FIELDS * BITS).alias("place")), lambda c: F.struct(
            c["number"].alias("number"), c["place"].alias("place"), F.call_function("shiftleft", F.lit(1).cast("long"), c["place"]).alias("one")))

    def count(counts: Column, code: Column) -> Column:
        return F.call_function("shiftright", F.get(counts, code["number"]), code["place"]).bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    def step(state: Column, i: Column, codes: Column) -> Column:
        entering, leaving = F.get(codes, i), F.get(codes, i - WINDOW)  # null past an end
        left = F.when(leaving.isNotNull(), F.get(rise, count(state["counts"], leaving) - 1)).otherwise(F.lit(0).cast("long"))
        same = F.when(leaving == entering, F.lit(1)).otherwise(F.lit(0))
        came = F.when(entering.isNotNull(), F.get(rise, count(state["counts"], entering) - same)).otherwise(F.lit(0).cast("long"))
        counts = F.transform(state["counts"], lambda x, j: x + add(entering, j) - add(leaving, j))

        def settled(total: Column) -> Column:
            high = entering.isNotNull() & (i + 1 >= WINDOW) & (total <= limit)
            start, end, last = begin + i + 1 - WINDOW, begin + i + 1, state["last"]
            apart = last.isNotNull() & ((high & (last["end"] < start)) | entering.isNull())  # after the last character too
            return F.struct(
                F.struct(total.alias("total"), counts.alias("counts"), F.when(high, F.when(
                    last["end"] >= start, _span(last["start"], 3, end)).otherwise(_span(start, 3, end))).otherwise(last).alias("last")).alias("state"),
                F.when(apart, F.array(last)).otherwise(F.array().cast(_SPAN)).alias("add"))

        return _let(state["total"] - left + came, settled)

    zero = F.struct(F.lit(0).cast("long").alias("total"), F.array(*[F.lit(0).cast("long")] * numbers).alias("counts"),
                    F.lit(None).cast("struct<start:int,kind:int,end:int>").alias("last"))
    return _let(F.transform(F.split(run, ""), coded), lambda codes: _collect(
        F.sequence(F.lit(0), F.size(codes)), zero, lambda state, i: step(state, i, codes)))


def _entropy_spans(candidate: Column, begin: Column) -> Column:
    """High-entropy spans of one candidate, over its classes."""
    def of_class(pattern: str, least: float) -> Column:
        runs = F.regexp_extract_all(candidate, F.lit(pattern), F.lit(0))
        placed = _positions(candidate, pattern, runs, 3)
        return F.flatten(F.zip_with(runs, placed, lambda run, at: _windows(run, begin + at["start"], least)))

    return F.array_distinct(F.concat(*[of_class(pattern, least) for pattern, least in CLASSES]))


def scan(df: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``sec_base`` and ``sec_spans``: arrays of (start, kind number, end), by start, then kind."""
    whole = F.coalesce(F.col(text), F.lit(""))
    found = df.select("*", F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(0)).alias("tw_assign"),
                      F.regexp_extract_all(whole, F.lit(ACCESS), F.lit(0)).alias("tw_access"),
                      F.regexp_extract_all(whole, F.lit(HEX), F.lit(0)).alias("tw_hex"),
                      F.regexp_extract_all(whole, F.lit(CANDIDATE), F.lit(0)).alias("tw_candidate"))
    assigned = F.when(F.size("tw_assign") > 0, F.zip_with(
        F.regexp_extract_all(whole, F.lit(ASSIGN), F.lit(2)), _positions(whole, ASSIGN, F.col("tw_assign"), 0),
        lambda value, span: F.when(F.char_length(value) >= ASSIGN_LEAST, span)))
    access = F.filter(_positions(whole, ACCESS, F.col("tw_access"), 1), lambda x: x["end"] - x["start"] >= ACCESS_LEAST)
    base = F.concat(F.coalesce(F.filter(assigned, lambda x: x.isNotNull()), F.array().cast(_SPAN)), access,
                    _positions(whole, HEX, F.col("tw_hex"), 2))
    suspicious = F.exists("tw_candidate", lambda c: ~_is_allowed(c))
    placed = F.when(suspicious, _positions(whole, CANDIDATE, F.col("tw_candidate"), 3))
    found = found.select(*df.columns, "tw_candidate", F.array_sort(base).alias("sec_base"), placed.alias("tw_placed"))
    entropy = F.flatten(F.zip_with("tw_candidate", "tw_placed", lambda c, at: F.when(
        _is_allowed(c), F.array().cast(_SPAN)).otherwise(_entropy_spans(c, at["start"]))))
    every = F.array_sort(F.concat("sec_base", F.coalesce(F.when(F.col("tw_placed").isNotNull(), entropy), F.array().cast(_SPAN))))
    # in this order all base spans that may hold an entropy span stand before it: the furthest end so far decides
    kept = _collect(every, F.lit(0), lambda far, x: F.struct(
        F.when(x["kind"] < 3, F.greatest(far, x["end"])).otherwise(far).alias("state"),
        F.when((x["kind"] < 3) | (x["end"] > far), F.array(x)).otherwise(F.array().cast(_SPAN)).alias("add")))
    return found.select(*df.columns, "sec_base", kept.alias("sec_spans"))


def _is_allowed(candidate: Column) -> Column:
    out = F.lit(False)
    for pattern in ALLOWED:
        out = out | candidate.rlike(f"^(?:{pattern})$")
    return out


def listed(spans: str | Column) -> Column:
    """Spans as kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Per document: the counts of the base kinds, their digest and all spans."""
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    count = lambda kind: F.size(F.filter("sec_base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    return found.select("doc_id", count(0), count(1), count(2), F.sha2(listed("sec_base"), 256).alias("base_sha256"),
                        listed("sec_spans").alias("spans"))


def _sql_spans(pattern: str, kind: int, source: str) -> str:
    """DuckDB: all matches of a pattern with their places, one row each."""
    quoted = pattern.replace("'", "''")
    return f"""
    SELECT doc_id, txt, {kind} AS kind, m[k] AS hit, b + len(array_to_string(p[1:k], '')) + len(array_to_string(m[1:k - 1], '')) AS s,
           b + len(array_to_string(p[1:k], '')) + len(array_to_string(m[1:k], '')) AS e
    FROM (SELECT doc_id, txt, b, p, m, unnest(generate_series(1, len(m))) AS k
          FROM (SELECT doc_id, txt, b, string_split_regex(txt, '{quoted}') AS p, regexp_extract_all(txt, '{quoted}', 0) AS m FROM {source}))"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS txt, 0 AS b FROM documents),
assign AS (SELECT doc_id, s, kind, e FROM ({_sql_spans(ASSIGN, 0, 'd')})
           WHERE len(regexp_extract(hit, '{ASSIGN.replace("'", "''")}', 2)) >= {ASSIGN_LEAST}),
access AS (SELECT doc_id, s, kind, e FROM ({_sql_spans(ACCESS, 1, 'd')}) WHERE e - s >= {ACCESS_LEAST}),
hex AS (SELECT doc_id, s, kind, e FROM ({_sql_spans(HEX, 2, 'd')})),
base AS (FROM assign UNION ALL FROM access UNION ALL FROM hex),
candidate AS (
  SELECT doc_id, hit AS txt, s AS b FROM ({_sql_spans(CANDIDATE, 3, 'd')})
  WHERE {" AND ".join(f"NOT regexp_full_match(hit, '{p}')" for p in ALLOWED)}),
runs AS ({" UNION ALL ".join(f"SELECT doc_id, b, hit, s, e, {i} AS class, {least} AS least FROM (SELECT *, 0 AS b FROM ({_sql_spans(p, 3, 'candidate')}))" for i, (p, least) in enumerate(CLASSES))}),
windows AS (
  SELECT doc_id, class, s AS run, least, s + i AS ws, s + i + {WINDOW} AS we, string_split(substr(hit, i + 1, {WINDOW}), '') AS cs
  FROM (SELECT *, unnest(generate_series(0, e - s - {WINDOW})) AS i FROM runs)),
high AS (
  SELECT doc_id, class, run, ws, we FROM windows
  WHERE list_sum(list_transform(list_distinct(cs), lambda x: -(len(list_filter(cs, lambda y: y = x)) / {WINDOW}.0) * log2(len(list_filter(cs, lambda y: y = x)) / {WINDOW}.0))) >= least - 1e-9),
merged AS (
  SELECT doc_id, min(ws) AS s, 3 AS kind, max(we) AS e
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, class, run ORDER BY ws) AS part
        FROM (SELECT *, CASE WHEN ws > coalesce(max(we) OVER (PARTITION BY doc_id, class, run ORDER BY ws ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) THEN 1 ELSE 0 END AS fresh FROM high))
  GROUP BY doc_id, class, run, part),
spans AS (
  FROM base UNION ALL
  SELECT DISTINCT m.doc_id, m.s, m.kind, m.e FROM merged m
  WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = m.doc_id AND b.s <= m.s AND m.e <= b.e)),
names AS (SELECT unnest(range(4)) AS kind, unnest({list(KINDS)}) AS name),
per AS (
  SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
         coalesce(string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) FILTER (kind < 3), '') AS base,
         string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, kind, e) AS spans
  FROM spans JOIN names USING (kind) GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per USING (doc_id)
"""
