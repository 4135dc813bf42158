"""Quality rules with thresholds that adapt to each language and source.

Texts are measured by SQL functions. The measures of all documents go into
quantile sketches, one for each (lang, source, measure): histograms whose buckets are exact
below 128 thousandths and keep seven leading bits above it, so that a quantile is off by
less than 1/64 of itself. Sketches merge by adding counts: (lang, source) sketches add up to
those of the language, and these to the global one.

The limit of a measure follows its group's sketch: a high quantile h, plus five times its distance
from the median. The quantile is chosen for the share of junk that a measure may hold. Groups borrow
from wider ones: a fence of n documents is weighed n against 200 of the next wider group's limit, and may
not exceed twice that limit, so a source of junk cannot set its own standard. Last, a limit is held
between a noise guard, the share that a single chance repeat or symbol gives, and a ceiling.

Defined results: a null text has no words and fails the base rule; a null lang or source is
a group of its own; repeated rows are judged one by one, alike; an empty table gives an
empty table. Columns beside ``text``, ``lang`` and ``source`` are passed through; the
measures are held in one struct whose name no table should use (``_measures``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cohortgraph.llm.common import documents, guarded, keep, let, unsent, words

#: Ratio: numerator, denominator, percent of the high quantile, noise guard and ceiling of the limit in thousandths.
RATIOS = {
    "symbols": ("n_symbols", "n_words", 90, 50, 1000),
    "dup_lines": ("n_dup_lines", "n_lines", 95, 340, 900),
    "repeats": ("n_repeat_words", "n_words", 95, 100, 500),
    "capitals": ("n_capitals", "word_chars", 95, 30, 800),
}
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Documents that a wider group's limit counts as.
PRIOR = 200
FENCE = 5
#: A group's fence exceeds the wider group's limit at most so many times.
EXCESS = 2
NO_VALUE = "\x00null"


def repeated_words(found: Column) -> Column:
    """Words of an array that lie in a 3-word window found at least twice.

    Windows are (hash, position) pairs, sorted, so that equal ones are neighbours: no step
    takes more than n log n.
    """
    windows = let(
        found,
        lambda w: F.transform(
            F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
            lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")),
        ),
    )
    starts = let(
        F.sort_array(windows),
        lambda s: F.filter(
            F.transform(
                s,
                lambda x, i: F.when(
                    (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"]), x["i"]
                ),
            ),
            lambda i: i.isNotNull(),
        ),
    )
    return F.size(F.array_distinct(F.flatten(F.transform(starts, lambda i: F.array(i, i + 1, i + 2))))).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_measures`` of counts over the whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    line_counts = let(
        lines,
        lambda s: F.struct(
            F.size(s).cast("long").alias("n_lines"),
            (F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        ),
    )
    return docs.withColumn(
        "_measures",
        let(
            F.struct(counts.alias("w"), line_counts.alias("l")),
            lambda c: F.struct(
                *(c["w"][name].alias(name) for name in ("n_words", "word_chars", "n_repeat_words")),
                *(c["l"][name].alias(name) for name in ("n_lines", "n_dup_lines")),
                F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            ),
        ),
    )


def base_failed() -> Column:
    m = F.col("_measures")
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def ratio(name: str) -> Column:
    """Thousandths, rounded down."""
    over, under = RATIOS[name][:2]
    m = F.col("_measures")
    return F.floor(1000 * m[over] / F.greatest(m[under], F.lit(1)))


def bucket(value: Column) -> Column:
    """Lower end of the sketch's bucket: all bits up to seven, then the leading seven."""
    drop = F.greatest(F.length(F.bin(value)) - 7, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def _key(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(NO_VALUE))


def sketches(docs: DataFrame) -> DataFrame:
    """(lang_key, source_key, measure, bucket, n) of the documents that pass the base rule."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), bucket(ratio(k)).alias("bucket")) for k in RATIOS)))
    sound = docs.where(~base_failed())
    return (
        sound.select(_key("lang").alias("lang_key"), _key("source").alias("source_key"), pairs.alias("p"))
        .groupBy("lang_key", "source_key", F.col("p.measure").alias("measure"), F.col("p.bucket").alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fences(sketch: DataFrame, *by: str) -> DataFrame:
    """Size and fence of each measure for the groups ``by``, from merged sketches."""
    merged = sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*by, "measure")
    percent = of_measure(2)
    seen = merged.select(
        *by,
        "measure",
        "bucket",
        F.sum("n").over(whole.orderBy("bucket")).alias("upto"),
        F.sum("n").over(whole).alias("size"),
    )
    at = [F.min(F.when(100 * F.col("upto") >= q * F.col("size"), F.col("bucket"))) for q in (F.lit(50), percent)]
    ends = seen.groupBy(*by, "measure").agg(F.max("size").alias("size"), at[0].alias("mid"), at[1].alias("high"))
    return ends.select(*by, "measure", "size", (F.col("high") + FENCE * (F.col("high") - F.col("mid"))).alias("fence"))


def of_measure(part: int) -> Column:
    """That part of the row's measure in RATIOS."""
    return F.element_at(F.create_map(*(F.lit(x) for name, r in RATIOS.items() for x in (name, r[part]))), F.col("measure"))


def held(limit: Column) -> Column:
    return F.least(F.greatest(limit, of_measure(3)), of_measure(4))


def borrowed(fence: Column, size: Column, wider: Column) -> Column:
    """A group's limit: its fence, at most EXCESS times the wider limit, weighed against that limit."""
    own = F.least(fence, EXCESS * wider)
    return held(F.floor((size * own + PRIOR * wider) / (size + PRIOR)))


def thresholds(docs: DataFrame) -> DataFrame:
    """One row for each (lang_key, source_key) with a limit for each of RATIOS.

    A group without sound documents has no row; its documents have failed already.
    """
    sketch = keep(sketches(docs), "sketches")
    own, by_lang, whole = fences(sketch, "lang_key", "source_key"), fences(sketch, "lang_key"), fences(sketch)
    whole = whole.select("measure", held(F.col("fence")).alias("all_limit"))
    by_lang = by_lang.join(whole, "measure").select(
        "lang_key", "measure", borrowed(F.col("fence"), F.col("size"), F.col("all_limit")).alias("lang_limit")
    )
    chosen = own.join(unsent(by_lang), ["lang_key", "measure"]).select(
        "lang_key", "source_key", "measure", borrowed(F.col("fence"), F.col("size"), F.col("lang_limit")).alias("limit")
    )
    limits = [F.max(F.when(F.col("measure") == name, F.col("limit"))).alias(f"limit_{name}") for name in RATIOS]
    return chosen.groupBy("lang_key", "source_key").agg(*limits)


def judged(docs: DataFrame, limits: DataFrame) -> DataFrame:
    """Measured ``docs`` with booleans ``_base_failed`` and ``_kept``.

    Limits are one row for each group; adaptive execution broadcasts them if their measured
    size allows, and otherwise splits a hot group in the shuffled join.
    """
    keys = limits.withColumnsRenamed({c: f"_{c}" for c in limits.columns})
    joined = docs.join(keys, (_key("lang") == keys["_lang_key"]) & (_key("source") == keys["_source_key"]), "left")
    over = [ratio(name) > F.col(f"_limit_{name}") for name in RATIOS]
    bad = base_failed()
    kept = ~bad
    for test in over:
        kept = kept & ~F.coalesce(test, F.lit(False))
    return joined.select(*docs.columns, bad.alias("_base_failed"), kept.alias("_kept"))


def quality_filter(docs: DataFrame) -> DataFrame:
    """The documents that pass, all columns unchanged.

    The measures are kept for the sketches and taken again with the texts: that costs less
    disk than a copy of all texts beside their measures. The verdict is tested as a whole, after
    the join: a part of it pushed below the join would measure each text again.
    """
    limits = thresholds(keep(measured(docs).select("_measures", "lang", "source"), "measured"))
    return judged(measured(docs), limits).where(F.coalesce("_kept", F.lit(False))).select(*docs.columns)


@guarded
def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    table = keep(measured(docs).drop("text"), "measured")
    return judged(table, thresholds(table)).select(
        "doc_id",
        *(F.col("_measures")[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        F.col("_base_failed").alias("base_failed"),
        F.col("_kept").alias("kept"),
    )


def _case_sql(part: int) -> str:
    return "CASE measure " + " ".join(f"WHEN '{name}' THEN {r[part]}" for name, r in RATIOS.items()) + " END"


def _held_sql(limit: str) -> str:
    return f"least(greatest({limit}, {_case_sql(3)}), {_case_sql(4)})"


def _borrowed_sql(wider: str) -> str:
    return _held_sql(f"(size * least(fence, {EXCESS} * {wider}) + {PRIOR} * {wider}) // (size + {PRIOR})")


def _fences_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""(
    SELECT {keys}measure, size, high + {FENCE} * (high - mid) AS fence FROM (
      SELECT {keys}measure, max(size) AS size, min(bucket) FILTER (100 * upto >= 50 * size) AS mid,
             min(bucket) FILTER (100 * upto >= {_case_sql(2)} * size) AS high
      FROM (SELECT {keys}measure, bucket, sum(n) OVER (PARTITION BY {keys}measure ORDER BY bucket) AS upto,
                   sum(n) OVER (PARTITION BY {keys}measure) AS size
            FROM (SELECT {keys}measure, bucket, sum(n) AS n FROM sketch GROUP BY ALL))
      GROUP BY {keys}measure))"""


def _sql() -> str:
    ratios = "\n    UNION ALL ".join(
        f"SELECT doc_id, lang_key, source_key, bad, '{name}' AS measure, "
        f"CAST(floor(1000 * {over} / greatest({under}, 1)) AS BIGINT) AS v FROM m"
        for name, (over, under, *_) in RATIOS.items()
    )
    return rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '{NO_VALUE[1:]}?') AS lang_key,
                  coalesce(source, '{NO_VALUE[1:]}?') AS source_key FROM documents),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
      FROM (SELECT doc_id, regexp_extract_all(text, '{WORD_SQL}') AS ws FROM t)),
g AS (SELECT doc_id, i, word, lead(word) OVER d AS b, lead(word, 2) OVER d AS c
      FROM w WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, word, b, c) AS n FROM g WHERE c IS NOT NULL)
      WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM r, (VALUES (0), (1), (2)) AS s(o) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM t)
          WHERE regexp_matches(line, '{WORD_SQL}') GROUP BY doc_id),
m0 AS (SELECT t.doc_id, lang_key, source_key,
         CAST(len(regexp_extract_all(text, '{WORD_SQL}')) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(regexp_extract_all(text, '\p{{Lu}}')) AS BIGINT) AS n_capitals,
         coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
       FROM t LEFT JOIN rep USING (doc_id) LEFT JOIN lines USING (doc_id)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS bad FROM m0),
ratios AS ({ratios}),
sketch AS (SELECT lang_key, source_key, measure,
             (v >> greatest(length(bin(v)) - 7, 0)) << greatest(length(bin(v)) - 7, 0) AS bucket, count(*) AS n
           FROM ratios WHERE NOT bad GROUP BY ALL),
own AS {_fences_sql("lang_key, source_key")},
by_lang AS {_fences_sql("lang_key")},
whole AS {_fences_sql("")},
all_limits AS (SELECT measure, {_held_sql("fence")} AS all_limit FROM whole),
lang_limits AS (SELECT lang_key, measure, {_borrowed_sql("all_limit")} AS lang_limit
                FROM by_lang JOIN all_limits USING (measure)),
limits AS (SELECT lang_key, source_key, measure, {_borrowed_sql("lang_limit")} AS lim
           FROM own JOIN lang_limits USING (lang_key, measure)),
over AS (SELECT DISTINCT doc_id FROM ratios JOIN limits USING (lang_key, source_key, measure) WHERE v > lim)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, bad AS base_failed,
       NOT bad AND doc_id NOT IN (FROM over) AS kept
FROM m"""


#: The word pattern as RE2 reads it in DuckDB.
WORD_SQL = r"[^\x20\x09-\x0D]+"
OP6_SQL = _sql()
