"""Quality rules whose cutoffs come from mergeable quantile sketches per language and source."""

from __future__ import annotations

import math
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from homespan.llm.text import rows_of

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
#: Relative width of a sketch bucket; a quantile read from the sketch is within this of the exact one.
RELATIVE_ERROR = 0.01
#: Values at or below this share one bucket.
SMALLEST = 1e-4
#: A rate is an outlier beyond median + REACH * (90 % quantile - median + slack); the slack is the least spread assumed.
REACH = 5.0
SLACK = {"symbol_rate": 0.01, "dup_line_rate": 0.04, "repeat_rate": 0.04, "word_length": 0.6, "shout_rate": 0.03,
         "capital_rate": 0.03}
#: Cells with fewer documents than this take the thresholds of their language, and those of all documents after that.
MIN_CELL = 30
#: The thresholds are sent to every task up to this many cells, beyond that they are joined by a shuffle.
BROADCAST_CELLS = 100_000
RATES = tuple(SLACK)
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_EXTRA = ("n_lines", "n_shouts", "n_capitals")
_CAPITALS = bytes(range(65, 91))


def measure_text(text: str | None) -> tuple[int, ...]:
    """The counts of one text, in the order of _COUNTS and _EXTRA."""
    text = text or ""
    raw = text.encode()
    found = raw.split()
    spaces = len(raw) - sum(map(len, found))
    windows = list(zip(found, found[1:], found[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen = Counter(windows)
        reach = -1
        for i, window in enumerate(windows):
            if seen[window] > 1:
                repeated += 3 - max(0, reach - i + 1)
                reach = i + 2
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (len(found), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated,
            len(lines), text.count("!"), len(raw) - len(raw.translate(None, _CAPITALS)))


_MEASURES = pa.struct([(name, pa.int64()) for name in _COUNTS + _EXTRA])


@F.arrow_udf(T.StructType([T.StructField(name, T.LongType()) for name in _COUNTS + _EXTRA]))
def _measures(texts: pa.Array) -> pa.Array:
    rows = [measure_text(t) for part in rows_of(texts) for t in part]
    columns = list(zip(*rows)) or [[]] * len(_MEASURES)
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=list(_MEASURES))


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The rows with a struct ``_m`` of counts; a null text counts as empty. Nothing else is read or changed."""
    return docs.withColumn("_m", _measures.asNondeterministic()(F.col(text_column)))


def _rates() -> dict[str, Column]:
    m = lambda name: F.col(f"_m.{name}").cast("double")
    per = lambda part, whole: part / F.greatest(whole, F.lit(1.0))
    return {"symbol_rate": per(m("n_symbols"), m("word_chars")), "dup_line_rate": per(m("n_dup_lines"), m("n_lines")),
            "repeat_rate": per(m("n_repeat_words"), m("n_words")), "word_length": per(m("word_chars"), m("n_words")),
            "shout_rate": per(m("n_shouts"), m("n_words")), "capital_rate": per(m("n_capitals"), m("word_chars"))}


def base_failed() -> Column:
    return (F.col("_m.n_words") < MIN_WORDS) | (100 * F.col("_m.n_repeat_words") > 50 * F.col("_m.n_words"))


_GAMMA = math.log((1 + RELATIVE_ERROR) / (1 - RELATIVE_ERROR))


def sketches(rows: DataFrame) -> DataFrame:
    """Quantile sketches of the rates of the rows that pass the base rules: (lang, source, rate, bucket, n).

    A sketch is a histogram over logarithmic buckets. Two sketches merge by adding counts, so partial sums are made before
    the shuffle and a hot source costs no more than a small one; the order of merging changes nothing.
    """
    stacked = F.array(*[F.struct(F.lit(name).alias("rate"), value.alias("value")) for name, value in _rates().items()])
    long = rows.where(~base_failed()).select("lang", "source", F.explode(stacked).alias("r"))
    bucket = F.when(F.col("r.value") <= SMALLEST, 0).otherwise(
        1 + F.floor(F.log(F.col("r.value") / SMALLEST) / _GAMMA)).cast("int")
    return long.groupBy("lang", "source", F.col("r.rate").alias("rate"), bucket.alias("bucket")).agg(
        F.count("*").alias("n"))


def thresholds(merged: DataFrame) -> DataFrame:
    """Upper limits from sketches: (level, lang, source, one column per rate).

    Level 0 has one row per language and source with at least ``MIN_CELL`` documents, level 1 per language, level 2 one
    row for all: the coarser sketches are the finer ones merged.
    """
    sizes = F.sum("n")
    merged = merged.select("lang", "source", "rate", "bucket", "n")
    none = F.lit(None).cast("string")
    levels = [merged.withColumn("level", F.lit(0)),
              merged.groupBy("lang", "rate", "bucket").agg(sizes.alias("n")).withColumns(
                  {"source": none, "level": F.lit(1)}),
              merged.groupBy("rate", "bucket").agg(sizes.alias("n")).withColumns(
                  {"lang": none, "source": none, "level": F.lit(2)})]
    every = levels[0].unionByName(levels[1]).unionByName(levels[2])
    cell = Window.partitionBy("level", "lang", "source", "rate")
    running = every.withColumns({"upto": F.sum("n").over(cell.orderBy("bucket")), "total": F.sum("n").over(cell)})
    middle = F.when(F.col("bucket") == 0, 0.0).otherwise(SMALLEST * F.exp((F.col("bucket") - 0.5) * _GAMMA))

    def quantile(q: float) -> Column:
        return F.min(F.when(F.col("upto") >= q * F.col("total"), middle))

    cells = running.groupBy("level", "lang", "source", "rate", "total").agg(
        quantile(0.5).alias("q50"), quantile(0.9).alias("q90"))
    slack = F.create_map(*[F.lit(x) for pair in SLACK.items() for x in pair])[F.col("rate")]
    limit = F.col("q50") + REACH * (F.col("q90") - F.col("q50") + slack)
    kept = cells.where((F.col("level") == 2) | (F.col("total") >= MIN_CELL))
    return kept.withColumn("limit", limit).groupBy("level", "lang", "source").agg(
        *[F.min(F.when(F.col("rate") == name, F.col("limit"))).alias(name) for name in RATES])


def judged(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """The measured rows with ``_verdict`` (base_failed, kept, the limits applied), joined by language and source.

    A null language or source is a cell of its own. Without any limits (no row passes the base rules) the base decides.
    """
    n = limits.count()
    hint = F.broadcast if n <= BROADCAST_CELLS else (lambda df: df)
    out = rows
    for level, keys in ((0, ["lang", "source"]), (1, ["lang"]), (2, [])):
        part = limits.where(F.col("level") == level).select(
            *[F.col(k).alias(f"_{k}{level}") for k in keys], F.struct(*RATES).alias(f"_limit{level}"))
        if keys:
            same = [F.col(k).eqNullSafe(F.col(f"_{k}{level}")) for k in keys]
            out = out.join(hint(part), same[0] if len(same) == 1 else same[0] & same[1], "left")
        else:
            one = part.first()  # one row, or none
            values = one[0].asDict() if one else {}
            out = out.withColumn("_limit2", F.struct(*[F.lit(values.get(r)).cast("double").alias(r) for r in RATES]))
    limit = {r: F.coalesce(*[F.col(f"_limit{k}.{r}") for k in range(3)]) for r in RATES}
    outlier = F.lit(False)
    for name, value in _rates().items():
        outlier = outlier | F.coalesce(value > limit[name], F.lit(False))
    verdict = F.struct(base_failed().alias("base_failed"), (~base_failed() & ~outlier).alias("kept"),
                       *[limit[r].alias(f"max_{r}") for r in RATES])
    return out.withColumn("_verdict", verdict).select(*rows.columns, "_verdict")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass the base rules and their cell's thresholds; columns and repeated rows stay as they are.

    Texts are measured twice, once for the sketches (without carrying the text along) and once beside each row, so
    no text is shuffled.
    """
    limits = thresholds(sketches(measured(docs.select("lang", "source", "text"))))
    return judged(measured(docs), limits).where("_verdict.kept").select(*docs.columns)
