"""Operator 9: quality rules with robust multivariate outliers.

A document that passes the base rules is rejected when its vector of transformed text
statistics lies far from those of its language and source. Location and scatter are
minimum-covariance-determinant estimates: concentration steps take the nearer half of the
rows, estimate anew from them, and go on until the determinant no longer falls. Of several
starts the one with the smallest determinant is kept, so that bad documents cannot pull
the centre to themselves while they are fewer than half. A last step reweights.

All rows count in the estimates. Vectors are whole numbers (1/256 steps), so equal ones
are counted together first and all sums are exact; each step is one aggregate over the
counted vectors of all cells together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caremesa.llm.common import c, settle

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MIN_WORDS, REPEAT_PERCENT = 10, 20

#: Transformed statistics and the smallest scale that each is given. A statistic that is nearly constant in a
#: cell would otherwise turn tiny differences into outliers. Each statistic alone can pass the cut (5.8 scales):
#: dup_lines and repeats reach 1 and 0.447 at most, and their spreads over clean rows are 0.07 and 0.06.
FLOORS = {"word_length": 0.10, "symbols": 0.08, "dup_lines": 0.12, "repeats": 0.055}
DIMENSIONS = len(FLOORS)
STEP = 256
#: Share of a cell's rows that an estimate rests on (their number is (n + DIMENSIONS + 1) / 2), concentration steps
#: before the first look whether an estimate still changes, rows a cell needs for an estimate of its own (else its
#: language's is taken, else that of all), chance that a regular row is rejected.
H, STEPS, MIN_ROWS, TAIL = 0.5, 5, 50, 1e-6
#: Starts at single vectors of a cell, beside the two at its medians.
POINTS = 4


def _chi2_tail(x: float, dimensions: int) -> float:
    """Chance beyond x for an even number of dimensions."""
    half, term, total = x / 2, 1.0, 0.0
    for k in range(dimensions // 2):
        total += term
        term *= half / (k + 1)
    return math.exp(-half) * total


def chi2_quantile(tail: float, dimensions: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2_tail(middle, dimensions) > tail else (low, middle)
    return high


def _consistency(share: float) -> float:
    """Makes the scatter of the central share of normal rows that of all rows."""
    return share / (1 - _chi2_tail(chi2_quantile(1 - share, DIMENSIONS), DIMENSIONS + 2))


def repeated_words(words: list[str]) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in windows), np.int64, len(windows))
    starts = np.flatnonzero(np.bincount(codes)[codes] > 1)
    covered = np.zeros(len(words) + 5, np.int64)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + 5, -1)
    return int(np.count_nonzero(np.cumsum(covered) > 0))


def text_statistics(text: str | None) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines with a word)."""
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        sum(map((text or "").count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _statistics(text: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([text_statistics(t) for t in text], columns=list(STATS), dtype="int64")


def _vector() -> list[Column]:
    """The transformed statistics in steps of 1/STEP; null where there is no word."""
    words, lines = F.nullif(c("n_words"), F.lit(0)), F.nullif(c("n_lines"), F.lit(0))
    ratios = [
        F.log(c("word_chars") / words),
        F.sqrt(c("n_symbols") / words),
        F.sqrt(c("n_dup_lines") / lines),
        F.sqrt(c("n_repeat_words") / words),
    ]
    return [F.round(ratio * STEP).cast("bigint").alias(f"x{i}") for i, ratio in enumerate(ratios)]


def _cell(level: int) -> Column:
    """Name of the cell of a row: its language and source, its language, or all rows. Nulls are values."""
    return F.to_json(F.struct(F.lit(level).alias("level"), *[c(name) for name in ("lang", "source")[:level]]))


_PARAMETERS = "cell string, start int, n bigint, centre array<double>, inverse array<double>, size double"


def _estimates(frames: Iterator[pd.DataFrame], factor: float) -> Iterator[pd.DataFrame]:
    """Centre, inverse scatter and logarithm of its determinant from the sums of each cell and start."""
    floor = np.diag([(STEP * f) ** 2 for f in FLOORS.values()])
    upper = np.triu_indices(DIMENSIONS)
    for frame in frames:
        found = []
        for row in frame.itertuples(index=False):
            centre = np.array(row.sums, float) / row.w
            scatter = np.zeros((DIMENSIONS, DIMENSIONS))
            scatter[upper] = np.array(row.products, float) / row.w
            scatter = np.triu(scatter) + np.triu(scatter, 1).T - np.outer(centre, centre)
            scatter = factor * scatter + floor
            inverse, size = np.linalg.inv(scatter), np.linalg.slogdet(scatter)[1]
            found.append((row.cell, row.start, row.n, centre.tolist(), inverse.ravel().tolist(), size))
        yield pd.DataFrame(found, columns=["cell", "start", "n", "centre", "inverse", "size"])


def _distance() -> Column:
    """Squared Mahalanobis distance of x0, x1, .. from ``centre``."""
    off = [c(f"x{i}") - c("centre")[i] for i in range(DIMENSIONS)]
    terms = [off[i] * off[j] * c("inverse")[i * DIMENSIONS + j] for i in range(DIMENSIONS) for j in range(DIMENSIONS)]
    return sum(terms[1:], terms[0])


def _concentrate(vectors: DataFrame, parameters: DataFrame, share: float | None) -> DataFrame:
    """Estimates from the nearer half of each cell, where a share is given, or from the rows within the 97.5 % ellipse."""
    pairs = [(i, j) for i in range(DIMENSIONS) for j in range(i, DIMENSIONS)]
    sums = [F.sum(c("w") * c(f"x{i}")).alias(f"s{i}") for i in range(DIMENSIONS)]
    sums += [F.sum(c("w") * c(f"x{i}") * c(f"x{j}")).alias(f"p{i}{j}") for i, j in pairs]
    names = ["w", *[f"s{i}" for i in range(DIMENSIONS)], *[f"p{i}{j}" for i, j in pairs]]
    measured = vectors.join(parameters, "cell").withColumn("d", _distance())
    if share is None:
        measured = measured.where(c("d") <= chi2_quantile(0.025, DIMENSIONS))
    # rows of nearly the same distance are taken or left together, so ties don't matter
    ring = F.floor(F.log2(1 + F.greatest(c("d"), F.lit(0.0))) * 64).cast("int") if share else F.lit(0)
    rings = measured.groupBy("cell", "start", "n", ring.alias("ring")).agg(F.sum("w").alias("w"), *sums)
    if share:
        inner = Window.partitionBy("cell", "start").orderBy("ring")
        before = F.sum("w").over(inner) - c("w")
        enough = F.least(c("n"), F.floor((c("n") + DIMENSIONS + 1) * share))
        rings = rings.withColumn("_before", before).where(c("_before") < enough)
    total = rings.groupBy("cell", "start", "n").agg(*[F.sum(name).alias(name) for name in names])
    total = total.select(
        "cell", "start", "n", "w",
        F.array(*[c(f"s{i}") for i in range(DIMENSIONS)]).alias("sums"),
        F.array(*[c(f"p{i}{j}") for i, j in pairs]).alias("products"),
    )
    factor = _consistency(share or 0.975)
    return total.mapInPandas(lambda frames: _estimates(frames, factor), _PARAMETERS)


def _starts(vectors: DataFrame) -> DataFrame:
    """First estimates of each cell: medians with scaled absolute deviations, medians with the floors, single vectors
    (distinct ones, picked by a hash) with the floors. Medians are exact; their state is bounded by the number of steps."""
    names = [f"x{i}" for i in range(DIMENSIONS)]
    middle = vectors.groupBy("cell").agg(F.sum("w").alias("n"), *[F.percentile(name, F.lit(0.5), c("w")).alias(f"m{name}") for name in names])
    middle = settle(middle)
    off = vectors.join(middle, "cell").select("cell", "w", *[F.abs(c(name) - c(f"m{name}")).alias(name) for name in names])
    spread = off.groupBy("cell").agg(*[F.percentile(name, F.lit(0.5), c("w")).alias(f"s{name}") for name in names])
    points = vectors.groupBy("cell").agg(
        *[F.min_by(F.array(*[c(name).cast("double") for name in names]), F.struct(F.xxhash64(F.lit(k), *names), *names)).alias(f"p{k}") for k in range(POINTS)],
    )
    floors = [STEP * floor for floor in FLOORS.values()]

    def diagonal(scales: list[Column]) -> Column:
        terms = [1 / (scale * scale) for scale in scales]
        return F.array(*[terms[i] if i == j else F.lit(0.0) for i in range(DIMENSIONS) for j in range(DIMENSIONS)])

    wide = diagonal([F.greatest(c(f"s{name}") * 1.4826, F.lit(floor)) for name, floor in zip(names, floors)])
    narrow = diagonal([F.lit(floor) for floor in floors])
    medians = F.array(*[c(f"m{name}") for name in names])
    pairs = [(medians, wide), (medians, narrow), *[(c(f"p{k}"), narrow) for k in range(POINTS)]]
    starts = F.array(*[F.struct(F.lit(k).alias("start"), centre.alias("centre"), inverse.alias("inverse")) for k, (centre, inverse) in enumerate(pairs)])
    found = middle.join(spread, "cell").join(points, "cell").select("cell", "n", F.explode(starts).alias("_s"))
    return found.select("cell", "_s.start", "n", "_s.centre", "_s.inverse", F.lit(math.inf).alias("size"), F.lit(True).alias("moves"))


def _step(vectors: DataFrame, parameters: DataFrame) -> DataFrame:
    """One concentration step of the starts that still move; one whose determinant does not fall stops where it is."""
    moved = _concentrate(vectors, parameters.where("moves").drop("size", "moves"), H)
    moved = moved.select("cell", "start", *[c(name).alias(f"_{name}") for name in ("centre", "inverse", "size")])
    smaller = F.coalesce(c("_size") < c("size"), F.lit(False))
    pick = [F.when(smaller, c(f"_{name}")).otherwise(c(name)).alias(name) for name in ("centre", "inverse", "size")]
    joined = parameters.join(moved, ["cell", "start"], "left")
    return settle(joined.select("cell", "start", "n", *pick, smaller.alias("moves")))


def fit(statistics: DataFrame) -> DataFrame:
    """Estimates per (lang, source): columns _lang, _source, centre, inverse."""
    good = statistics.where(~c("base_failed"))
    counted = settle(good.groupBy("lang", "source", *_vector()).agg(F.count(F.lit(1)).alias("w")))
    names = [f"x{i}" for i in range(DIMENSIONS)]
    cells = counted.select(F.explode(F.array(*[_cell(k) for k in (2, 1, 0)])).alias("cell"), "w", *names)
    vectors = settle(cells.groupBy("cell", *names).agg(F.sum("w").alias("w")))
    parameters = settle(_starts(vectors))
    steps = 0
    while steps < STEPS or not parameters.where("moves").isEmpty():
        parameters = _step(vectors, parameters)
        steps += 1
    # the start of the smallest determinant; of equal ones the first
    order = F.struct("size", "start")
    best = parameters.groupBy("cell").agg(F.min_by(F.struct("start", "n", "centre", "inverse"), order).alias("best"))
    parameters = settle(_concentrate(vectors, settle(best.select("cell", "best.*")), None))
    # the finest cell of each language and source that has enough rows
    named = counted.select("lang", "source").distinct()
    named = named.select("lang", "source", F.posexplode(F.array(*[_cell(k) for k in range(3)])).alias("level", "cell"))
    chosen = named.join(parameters.where(c("n") >= MIN_ROWS), "cell").groupBy("lang", "source")
    best = F.max_by(F.struct("centre", "inverse"), "level").alias("best")
    return settle(chosen.agg(best).select(c("lang").alias("_lang"), c("source").alias("_source"), "best.*"))


def judge(docs: DataFrame, carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Text statistics and verdicts of all rows of ``docs`` (text, lang, source).

    Returns the columns in ``carry``, the statistics, base_failed and kept. base_failed:
    fewer than 10 words, or more than 20 % of them in repeated 5-word windows. kept is
    false for these and for outliers of their cell.

    Nulls: a null text has no words; null languages and sources form cells of their own.
    A cell with fewer than 50 rows takes the estimates of its language, or else of all
    rows; where these have fewer too, only the base rules decide. Repeated rows count
    each and get the same verdict. An empty table gives no rows. Other columns are
    ignored unless carried; a carried column must not have a result's name.
    """
    measure = F.pandas_udf(_statistics, ", ".join(f"{name} bigint" for name in STATS))
    names = list(dict.fromkeys([*carry, "lang", "source"]))
    base_failed = (c("n_words") < MIN_WORDS) | (100 * c("n_repeat_words") > REPEAT_PERCENT * c("n_words"))
    statistics = settle(
        docs.select(*names, measure("text").alias("_stats")).select(*names, "_stats.*").withColumn("base_failed", base_failed)
    )
    joined = statistics.join(fit(statistics), c("lang").eqNullSafe(c("_lang")) & c("source").eqNullSafe(c("_source")), "left")
    measured = joined.select("*", *_vector()).withColumn("_far", _distance())
    outlier = F.coalesce(c("_far") > chi2_quantile(TAIL, DIMENSIONS), F.lit(False))
    return measured.select(*carry, *STATS[:-1], "base_failed", (~c("base_failed") & ~outlier).alias("kept"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, lang, source) that ``judge`` keeps, with all their columns as they are.

    Nulls, empty and long texts and repeated rows as in ``judge``: a null or empty text
    goes, as it has too few words. An empty table gives no rows. Other columns may have any names.
    """
    whole = F.struct(*(c(f"`{column}`") for column in docs.columns))
    return judge(docs.select(whole.alias("_row"), "text", "lang", "source"), ["_row"]).where("kept").select("_row.*")
