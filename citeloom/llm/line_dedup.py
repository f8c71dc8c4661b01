"""Repeated runs of lines by winnowing line hashes, from DataFrame operations only.

A unit is a line with a character other than white space together with the blank lines after
it (the first unit also has those before it); units are equal if their trimmed texts are. A run
of ``RUN`` units repeats if the same run begins at an earlier place that it does not overlap:
in a document of smaller id (and, for equal ids, smaller hash of the text), or further up in
the same one. Units of repeating runs are deleted; the first run of its kind stays.

1. Every ``GRAM`` consecutive units have a hash. Of every ``RUN - GRAM + 1`` consecutive ones the
   smallest is the fingerprint, the last of equal ones. Equal runs have equal fingerprints at equal
   places, so every run of ``RUN`` units is guaranteed one. Only the selected places are kept,
   each with the hashes of the units that stand within a run's reach before and after it.
2. Places are joined on their fingerprints; a fingerprint that stands at one place only leaves.
3. A match is extended both ways, unit by unit, to the runs that selected it: the units before and
   after decide which of the places are the same run, and the earliest of those stays. Longer
   repeats are the runs that follow each other, and all of their later units are deleted.

With ``passage_words``, one or two units that hold as many words together are runs as well,
whatever the number of units around them, so that passages written as one or two long lines
are found too. Such a run is its own fingerprint and needs no extension.

Hot lines: places of a fingerprint are counted, and the earliest of an extended match is found, by
grouping, which combines before the shuffle; both are joined back by joins that split a hot key. Pairs
of places are never made.

Cases: null and empty texts have no units and stay; a text that loses all its units becomes
empty; rows that repeat id and text are one document and get the same text; a null id comes
first in order; other columns are kept; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citeloom.llm.common import fresh
from citeloom.operators.joins import join_split
from citeloom.session import stage

RUN = 3
GRAM = 2
#: Words that make one or two units a passage.
PASSAGE_WORDS = 50
_BLANK = " \t\n\r\f\x0b"
_KEY = ["doc_id", "text_hash"]


def units(text: Column) -> Column:
    """The units of a text; put together with newlines they are the text."""
    return F.filter(F.split(text, r"\n(?=[^\n]*[^ \t\n\r\f\x0B])"), lambda u: F.btrim(u, F.lit(_BLANK)) != "")


def _grams(hashes: Column, size: int) -> Column:
    """A hash of every ``size`` consecutive elements."""
    last = F.size(hashes) - size
    return F.when(last < 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)]))
    )


def _minima(grams: Column, window: int) -> Column:
    """For every window of grams the place of its smallest, the last of equal ones."""
    last = F.size(grams) - window
    best = lambda i: F.array_max(F.transform(F.sequence(F.lit(0), F.lit(window - 1)), lambda k: F.struct(F.bitwise_not(F.get(grams, i + k)).alias("h"), (i + k).alias("at"))))
    return F.when(last < 0, F.array().cast("array<int>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: best(i)["at"]))


def fingerprints(docs: DataFrame, run: int = RUN, gram: int = GRAM) -> DataFrame:
    """The selected places of every document: (doc_id, text_hash, fingerprint, at, served, around).

    ``served`` tells how many units before the place the runs begin that selected it; ``around`` holds
    the hashes of the ``run - gram`` units before and after the place, null beyond the text.
    """
    reach = run - gram
    lined = docs.filter(F.size("lines") >= run).select(*_KEY, "lines", _grams(F.col("lines"), gram).alias("grams"))
    chosen = lined.withColumn("minima", _minima(F.col("grams"), reach + 1))

    def place(at: Column) -> Column:
        begins = F.filter(F.sequence(F.lit(0), F.lit(reach)), lambda k: F.get("minima", at - k) == at)
        beside = [F.get("lines", at + k) for k in (*range(-reach, 0), *range(gram, gram + reach))]
        # A place before the text would wrap round to none: get gives null for it.
        return F.struct(F.get("grams", at).alias("fingerprint"), at.alias("at"), begins.alias("served"), F.array(*beside).alias("around"))

    return chosen.select(*_KEY, F.inline(F.transform(F.array_distinct("minima"), place)))


def _extended(places: DataFrame, run: int, gram: int) -> DataFrame:
    """Matching places as the runs that selected them: (doc_id, text_hash, begin, size, match).

    ``match`` is the fingerprint with the units that the run has before and after it.
    """
    reach = run - gram
    each = places.select(*_KEY, "fingerprint", "at", "around", F.explode("served").alias("before"))
    # Of a run that begins `before` units earlier, so many units stand before the place and the rest after it.
    own = F.slice("around", F.lit(reach + 1) - F.col("before"), F.lit(reach))
    match = F.struct("fingerprint", F.col("before").alias("inside"), own.alias("beside"))
    return each.select(*_KEY, (F.col("at") - F.col("before")).alias("begin"), F.lit(run).alias("size"), match.alias("match"))


def _passages(docs: DataFrame, words: int, run: int) -> DataFrame:
    """Runs of fewer than ``run`` units with enough words, in the form of extended matches."""
    enough = lambda size: lambda i: (i <= F.size("lines") - size) & (sum(F.coalesce(F.get("words", i + k), F.lit(0)) for k in range(size)) >= words)
    none = F.array().cast("array<bigint>")

    def passage(size: int):
        own = lambda i: F.xxhash64(F.lit(size), *[F.get("lines", i + k) for k in range(size)])
        return lambda i: F.struct(i.alias("begin"), F.lit(size).alias("size"), F.struct(own(i).alias("fingerprint"), F.lit(-size).alias("inside"), none.alias("beside")).alias("match"))

    places = F.sequence(F.lit(0), F.size("lines") - 1)
    found = [F.transform(F.filter(places, enough(size)), passage(size)) for size in range(1, run)]
    return docs.filter(F.size("lines") >= 1).select(*_KEY, F.inline(F.concat(*found)))


def repeated_units(docs: DataFrame, run: int = RUN, gram: int = GRAM, passage_words: int | None = None) -> DataFrame:
    """(doc_id, text_hash, deleted) of the documents that lose units; ``deleted`` lists their places."""
    bare = lambda u: F.btrim(u, F.lit(_BLANK))
    own = units(F.col("text"))
    lines = F.transform(own, lambda u: F.xxhash64(bare(u))).alias("lines")
    words = F.transform(own, lambda u: F.size(F.split(bare(u), r"[ \t\n\r\f\x0B]+"))).alias("words")
    hashes = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), lines, *([] if passage_words is None else [words]))

    places = stage(fingerprints(hashes, run, gram).distinct(), "fingerprints")
    place = F.struct("doc_id", "text_hash", "at")
    shared = places.groupBy("fingerprint").agg(F.min(place).alias("p0"), F.max(place).alias("p1")).filter("p0 <> p1").select("fingerprint")
    found = _extended(join_split(places, shared, ["fingerprint"], "left_semi"), run, gram)
    if passage_words is not None:
        found = found.unionByName(stage(_passages(hashes, passage_words, run).distinct(), "passages"))

    first = found.groupBy("match").agg(F.min(F.struct("doc_id", "text_hash", "begin")).alias("first"))
    same_doc = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    later = join_split(found, first, ["match"]).filter(~same_doc | (F.col("begin") >= F.col("first.begin") + F.col("size"))).select(*_KEY, "begin", "size")
    covered = later.select(*_KEY, F.explode(F.sequence("begin", F.col("begin") + F.col("size") - 1)).alias("unit"))
    return covered.groupBy(*_KEY).agg(F.array_sort(F.collect_set("unit")).alias("deleted"))


def delete_repeated_lines(docs: DataFrame, counts: tuple[str, str, str], run: int = RUN, gram: int = GRAM, passage_words: int | None = None) -> DataFrame:
    """``docs`` with the repeated units taken out of ``text``, all columns kept.

    Adds under the names in ``counts`` the number of units, of deleted ones and of maximal
    deleted runs.
    """
    gone = stage(repeated_units(docs, run, gram, passage_words), "deleted")
    own_id, own_text, places = (fresh(docs, n) for n in ("gone_id", "gone_text", "deleted"))
    gone = gone.select(F.col("doc_id").alias(own_id), F.col("text_hash").alias(own_text), F.col("deleted").alias(places))
    # What is deleted grows with the corpus and has no size bound, so it is never broadcast.
    joined = docs.join(gone.hint("merge"), docs["doc_id"].eqNullSafe(gone[own_id]) & (F.xxhash64(docs["text"]) == gone[own_text]), "left")
    deleted = gone[places]
    left = F.array_join(F.filter(units(docs["text"]), lambda u, i: ~F.array_contains(deleted, i)), "\n")
    return joined.select(
        *[F.when(deleted.isNull(), docs["text"]).otherwise(left).alias("text") if c == "text" else docs[c] for c in docs.columns],
        F.when(docs["text"].isNull(), 0).otherwise(F.size(units(docs["text"]))).cast("bigint").alias(counts[0]),
        F.when(deleted.isNull(), 0).otherwise(F.size(deleted)).cast("bigint").alias(counts[1]),
        F.when(deleted.isNull(), 0).otherwise(F.size(F.filter(deleted, lambda x: ~F.array_contains(deleted, x - 1)))).cast("bigint").alias(counts[2]),
    )


def drop_repeated_lines(docs: DataFrame, passage_words: int | None = None) -> DataFrame:
    """The documents without their repeated runs; those that consist of nothing else go."""
    names = tuple(fresh(docs, n) for n in ("n_units", "n_deleted", "n_runs"))
    out = delete_repeated_lines(docs, names, passage_words=passage_words)
    return out.filter((F.col(names[1]) == 0) | (F.col(names[1]) < F.col(names[0]))).select(*docs.columns)


def _statement(runs: str) -> str:
    """The rows of the query as SQL, by comparing every run that ``runs`` lists (doc_id, unit, size, b0, b1, b2)."""
    return f"""
WITH lines AS (
  SELECT doc_id, u.pos AS pos, u.line AS line, trim(u.line, ' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)) AS body
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL) d,
       LATERAL (SELECT unnest(d.ls) AS line, generate_subscripts(d.ls, 1) AS pos) u
),
numbered AS (
  SELECT *, greatest(sum(CASE WHEN body <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos), 1) - 1 AS unit,
         sum(CASE WHEN body <> '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id) AS n_units
  FROM lines
),
units AS (
  SELECT doc_id, unit, string_agg(line, chr(10) ORDER BY pos) AS whole, max(body) AS body
  FROM numbered WHERE n_units > 0 GROUP BY doc_id, unit
),
counted AS (
  SELECT doc_id, unit, body, len(regexp_extract_all(body, '[^ \\t\\n\\r\\f\\x0B]+')) AS n FROM units
),
followed AS (
  SELECT doc_id, unit, body AS b0, lead(body, 1) OVER w AS b1, lead(body, 2) OVER w AS b2, n AS n0, lead(n, 1) OVER w AS n1
  FROM counted WINDOW w AS (PARTITION BY doc_id ORDER BY unit)
),
runs AS ({runs}),
firsts AS (SELECT size, b0, b1, b2, min((doc_id, unit)) AS f FROM runs GROUP BY size, b0, b1, b2),
later AS (
  SELECT r.doc_id, r.unit, r.size FROM runs r JOIN firsts f USING (size, b0, b1, b2)
  WHERE r.doc_id <> struct_extract_at(f.f, 1) OR r.unit >= struct_extract_at(f.f, 2) + r.size
),
deleted AS (SELECT DISTINCT doc_id, unit + k AS unit FROM later, (VALUES (0), (1), (2)) v(k) WHERE k < size),
kept AS (
  SELECT u.doc_id, count(*) AS n_units, count(d.unit) AS n_deleted,
         count(CASE WHEN d.unit IS NOT NULL AND p.unit IS NULL THEN 1 END) AS n_runs,
         coalesce(string_agg(CASE WHEN d.unit IS NULL THEN u.whole END, chr(10) ORDER BY u.unit), '') AS left_text
  FROM units u LEFT JOIN deleted d ON d.doc_id = u.doc_id AND d.unit = u.unit
       LEFT JOIN deleted p ON p.doc_id = u.doc_id AND p.unit = u.unit - 1
  GROUP BY u.doc_id
)
SELECT d.doc_id, coalesce(k.n_units, 0)::BIGINT AS n_units, coalesce(k.n_deleted, 0)::BIGINT AS n_deleted,
       coalesce(k.n_runs, 0)::BIGINT AS n_runs,
       CASE WHEN coalesce(k.n_deleted, 0) = 0 THEN sha256(coalesce(d.text, '')) ELSE sha256(k.left_text) END AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""


_WHOLE_RUNS = "SELECT doc_id, unit, 3 AS size, b0, b1, b2 FROM followed WHERE b2 IS NOT NULL"
_LONG_LINES = f"""
  UNION ALL SELECT doc_id, unit, 2, b0, b1, '' FROM followed WHERE b1 IS NOT NULL AND n0 + n1 >= {PASSAGE_WORDS}
  UNION ALL SELECT doc_id, unit, 1, b0, '', '' FROM followed WHERE n0 >= {PASSAGE_WORDS}"""

QUERY_SQL = _statement(_WHOLE_RUNS)
PASSAGE_SQL = _statement(_WHOLE_RUNS + _LONG_LINES)
