"""Quality rules whose cutoffs come with a guarantee: few good documents of a stratum are rejected wrongly.

Every document gets statistics over its whole text; a rule reads one of them as one of 65 bins. Labelled documents
are split by the crc32 of their ids. From the fitting part each bin of each rule gets a purity, the smoothed share of
bad documents among those that a cutoff there, or at a milder bin, would reject; a document's suspicion is the highest
purity of its bins. The possible rejections of a stratum are thus one nested sequence, fixed before the holdout is
looked at. On the holdout, cutoffs are tested from the strictest evidence down: the hypothesis that more than
``risk`` of the good documents are rejected must fail an exact binomial test at ``error / strata``. The sequence stops
at the first that does not (fixed-sequence testing inside a stratum, Bonferroni between strata), so with probability
``1 - error`` no stratum loses more than ``risk`` of its good documents to the learnt rules.

Edge cases: a null or empty text has no words, all its statistics are 0 and it fails the base rule; a stratum that is null is a stratum
of its own; one without enough labelled documents rejects nothing beyond the base rule; repeated rows get equal
verdicts, a repeated id counts once among the labelled (its least row); null ids are never learnt from; without labels or
documents there are no learnt rejections; other columns of the table may bear any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.llm.tables import stored
from medallion.llm.text import SPACE, Powers, bounds, mix, shingle_hashes, text_chunks

#: Largest share of good documents that a stratum may lose to the learnt rules, and the chance that any stratum loses more.
RISK, ERROR = 0.02, 0.05
#: Documents below this purity are never rejected.
LEAST_PURITY = 0.5
WINDOW_WORDS = 8
BINS = 64
#: Strata up to this number are broadcast (a few kilobytes each).
BROADCAST_STRATA = 1000

# The base rule and the symbols of the query contract.
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_RULES = ("long_words", "short_words", "symbols", "dup_lines", "repeats")


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """64-bit hash of each byte range, capitals told apart."""
    powers.reach(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers.up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64))


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between consecutive offsets."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[offsets[1:]] - total[offsets[:-1]]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per key whether it occurs again, and whether an equal one stands before it."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order[1:]] = equal
    again[order[1:]] |= equal
    again[order[:-1]] |= equal
    return again, later


def _measure(data: np.ndarray, offsets: np.ndarray, powers: Powers) -> dict[str, np.ndarray]:
    """All statistics of a part of a batch of texts, an array per statistic."""
    rows = len(offsets) - 1
    inside = ~SPACE[data]
    starts, ends = bounds(inside, offsets)
    first = np.searchsorted(starts, offsets)
    row_key = mix(np.arange(rows, dtype=np.uint64) + np.uint64(7))

    line_cuts = np.unique(np.concatenate([offsets, np.flatnonzero(data == 0x0A) + 1]))
    begin, end = line_cuts[:-1], line_cuts[1:].copy()
    end[data[end - 1] == 0x0A] -= 1  # a line's own text stops before its line feed
    worded = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end = begin[worded], end[worded]
    line_row = np.searchsorted(offsets, begin, side="right") - 1
    _, later = _repeated(_hashes(data, begin, end, powers) + row_key[line_row])

    counts = np.diff(first)
    windows, window_first = shingle_hashes(_hashes(data, starts, ends, powers), first, WINDOW_WORDS)
    window_row = np.repeat(np.arange(rows), np.diff(window_first))
    whole = counts[window_row] >= WINDOW_WORDS
    at = (first[:-1][window_row] + np.arange(len(windows)) - window_first[:-1][window_row])[whole]
    again, _ = _repeated(windows[whole] + row_key[window_row[whole]])
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + WINDOW_WORDS, -1)

    return {
        "n_words": counts,
        "word_chars": _per_row(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(_SYMBOL[data], offsets),
        "n_lines": np.bincount(line_row, minlength=rows),
        "n_dup_lines": np.bincount(line_row[later], minlength=rows),
        "n_repeat_words": _per_row(np.cumsum(cover)[:-1] > 0, first),
    }


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    powers = Powers()
    for batch in batches:
        for first, end, data, offsets in text_chunks(batch):
            found = _measure(data, offsets, powers)
            ids = batch.slice(first, end - first)
            columns = [pa.array(found[s].astype(np.int64)) for s in STATISTICS]
            yield pa.RecordBatch.from_arrays([ids.column("id"), ids.column("stratum"), *columns], names=["id", "stratum", *STATISTICS])


def text_statistics(docs: DataFrame, id_column: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """``id``, ``stratum`` and the statistics of every whole text."""
    rows = docs.select(docs[id_column].alias("id"), docs[stratum].alias("stratum"), docs[text].alias("text"))
    kinds = dict(rows.dtypes)
    schema = f"id {kinds['id']}, stratum {kinds['stratum']}, " + ", ".join(f"{s} long" for s in STATISTICS)
    return rows.mapInArrow(_statistics, schema)


def base_failed() -> Column:
    """Too short, or too much of it said before."""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _bin(value: str, of: str, steps: int) -> Column:
    """``steps * value / of`` in whole numbers, at most ``BINS``."""
    return F.least(F.expr(f"({steps} * {value}) div greatest({of}, 1)"), F.lit(BINS)).cast("int")


def rule_bins() -> dict[str, Column]:
    """Per rule a document's bin; higher bins are more suspicious."""
    bins = (
        _bin("word_chars", "n_words", 4),
        F.lit(BINS) - _bin("word_chars", "n_words", 8),
        _bin("n_symbols", "n_words", 32),
        _bin("n_dup_lines", "n_lines", BINS),
        _bin("n_repeat_words", "n_words", 2 * BINS),
    )
    return dict(zip(_RULES, bins, strict=True))


def labelled_rows(stats: DataFrame, labels: DataFrame, id_column: str = "doc_id", target: str = "quality") -> DataFrame:
    """A row per labelled id that passes the base rule: ``stratum``, ``good``, ``fitting`` and a bin per rule.

    Ids whose crc32 modulo 5 is 0 are left for measuring; 1 and 2 fit, 3 and 4 are the holdout.
    """
    part = F.crc32(F.col("id").cast("string").cast("binary")) % 5
    known = (
        labels.select(labels[id_column].alias("id"), labels[target].cast("int").alias("good"))
        .filter("good IN (0, 1)")
        .groupBy("id")
        .agg(F.max("good").alias("good"))
    )
    rows = stats.filter(F.col("id").isNotNull() & ~base_failed() & (part != 0))
    single = rows.groupBy("id").agg(F.min(F.struct("stratum", *STATISTICS)).alias("s")).select("id", "s.*")
    bins = [v.alias(k) for k, v in rule_bins().items()]
    return single.join(known, "id").select("stratum", (F.col("good") == 1).alias("good"), (part <= 2).alias("fitting"), *bins)


def purities(labelled: DataFrame) -> DataFrame:
    """Per stratum, rule and bin (all 65) the purity of the best cutoff at this bin or a milder one."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("rule"), F.col(r).alias("bin")) for i, r in enumerate(_RULES)))).alias("c")
    counts = (
        labelled.filter("fitting")
        .select("stratum", "good", each)
        .groupBy("stratum", "c.rule", "c.bin")
        .agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad"))
    )
    # One row of zeros for each bin makes the grid whole.
    grid = labelled.select("stratum").distinct().select(
        "stratum", F.explode(F.sequence(F.lit(0), F.lit(len(_RULES) - 1))).alias("rule"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad")
    ).withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(BINS))))
    whole = counts.unionByName(grid).groupBy("stratum", "rule", "bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    one = Window.partitionBy("stratum", "rule")  # 65 rows
    down = one.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
    up = one.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    good, bad = F.sum("good").over(down), F.sum("bad").over(down)
    rejected = whole.withColumn("purity", (2 * bad + 1) / (2 * (good + bad) + 2))
    return rejected.select("stratum", "rule", "bin", F.max("purity").over(up).alias("purity"))


def binomial_cdf(k: int, n: int, p: float) -> float:
    """Probability of at most ``k`` successes in ``n`` trials, by the continued fraction of the incomplete beta function."""
    if k >= n:
        return 1.0
    if k < 0:
        return 0.0
    return _incomplete_beta(n - k, k + 1, 1 - p)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, tiny = 1.0, 1 / _away(1 - (a + b) * x / (a + 1)), 1e-15
    value, m = d, 0
    while True:
        m += 1
        for up in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / _away(1 + up * d), _away(1 + up / c)
            value *= d * c
        if abs(d * c - 1) < tiny or m > 100_000:
            return scale * value


def _away(x: float) -> float:
    """``x``, but never 0."""
    return x if abs(x) > 1e-300 else 1e-300


def _certify(risk: float, level: float):
    """Marks rows whose ``lost`` of ``n`` rejections refute a false rejection rate above ``risk``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lost, n = batch.column("lost").to_pylist(), batch.column("n").to_pylist()
            sure = pa.array([binomial_cdf(k, m, risk) <= level for k, m in zip(lost, n, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("stratum"), batch.column("suspicion"), sure], names=["stratum", "suspicion", "sure"])

    return run


def _suspicion() -> Column:
    """A document's highest purity, from its stratum's flat array of them."""
    at = [F.element_at("purities", F.lit(i * (BINS + 1) + 1) + F.col(r)) for i, r in enumerate(_RULES)]
    return F.greatest(*at)


def _with_strata(rows: DataFrame, strata: DataFrame, few: bool) -> DataFrame:
    named = strata.withColumnRenamed("stratum", "_stratum")
    return rows.join(F.broadcast(named) if few else named, F.col("stratum").eqNullSafe(F.col("_stratum")), "left").drop("_stratum")


def cutoffs(labelled: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Per stratum its flat array of ``purities`` and the ``cutoff``: the least certified suspicion, null if there is none."""
    labelled = stored(labelled, "rules-labelled")
    values = stored(purities(labelled), "rules-purities")
    flat = F.array_sort(F.collect_list(F.struct("rule", "bin", "purity")))["purity"].alias("purities")
    strata = stored(values.groupBy("stratum").agg(flat), "rules-strata")
    few = strata.count() <= BROADCAST_STRATA
    good = labelled.filter(~F.col("fitting") & F.col("good"))
    seen = _with_strata(good, strata, few).groupBy("stratum", _suspicion().alias("suspicion")).agg(F.count("*").alias("lost"))
    tested = max(seen.select("stratum").distinct().count(), 1)
    candidates = values.select("stratum", F.col("purity").alias("suspicion"), F.lit(0).cast("long").alias("lost")).distinct()
    per_stratum = Window.partitionBy("stratum")  # at most 325 rows
    stricter = per_stratum.orderBy(F.desc("suspicion")).rowsBetween(Window.unboundedPreceding, 0)
    steps = seen.unionByName(candidates).groupBy("stratum", "suspicion").agg(F.sum("lost").alias("lost"))
    steps = steps.select("stratum", "suspicion", F.sum("lost").over(stricter).alias("lost"), F.sum("lost").over(per_stratum).alias("n"))
    kinds = dict(steps.dtypes)
    sure = steps.filter(F.col("suspicion") > LEAST_PURITY).mapInArrow(
        _certify(risk, error / tested), f"stratum {kinds['stratum']}, suspicion double, sure boolean"
    )
    least = sure.filter("sure").groupBy("stratum").agg(F.min("suspicion").alias("cutoff"))
    return _with_strata(strata, least, few)


def judge(stats: DataFrame, strata: DataFrame) -> DataFrame:
    """``stats`` with ``base_failed``, ``suspicion``, the stratum's ``cutoff`` and ``kept``."""
    few = strata.count() <= BROADCAST_STRATA
    binned = stats.withColumns({**rule_bins(), "base_failed": base_failed()})
    rows = _with_strata(binned, strata, few).withColumn("suspicion", _suspicion())
    rejected = F.coalesce(F.col("suspicion") >= F.col("cutoff"), F.lit(False))
    return rows.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("purities", *_RULES)


def keep_good(docs: DataFrame, labels: DataFrame, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Statistics and verdict for every row of ``docs``: ``id``, ``stratum``, the statistics and what ``judge`` adds."""
    stats = stored(text_statistics(docs), "rules-statistics")
    return judge(stats, stored(cutoffs(labelled_rows(stats, labels), risk, error), "rules-cutoffs"))
