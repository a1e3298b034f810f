"""Robust multivariate outliers: minimum covariance determinant per language and source.

Statistics of every text are transformed to a short vector. For each (lang, source) centre and scatter are
those of the ``SUPPORT`` share of its rows with the smallest determinant, approached by concentration
steps until the determinant stops falling: distances under the current estimate, the nearest rows, their mean
and covariance again. Every step is one aggregation over the stored vectors for all groups together, so a group with a third
of all rows is summed up by all tasks. A text goes when its Mahalanobis distance is too large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kilowise.llm.common import _SPACE, flat, mix, slices, word_hashes, word_places
from kilowise.plans.storage import materialize

SUPPORT = 0.75
FALL = 1e-4  # a logarithm of the determinant that falls by less has stopped
MIN_ROWS = 100  # rows of smaller groups are judged by their whole language, or if that is small, by all rows
CUTOFF = 35.9  # squared distance: the 1 - 1e-6 quantile of chi squared with five degrees
BROADCAST_ROWS = 500_000
DIMS = 5
# Log mean word length, log words, root shares of symbols, repeated lines and repeated words. Floors that keep the
# scatter regular where nearly all texts have the same value, such as no repeated line at all:
FLOOR = (0.01, 0.05, 0.02, 0.05, 0.05)
# and spreads that count as those of ``PRIOR_ROWS`` rows, so that a few rows do not make a narrow scatter by chance.
PRIOR = (0.1, 0.7, 0.1, 0.3, 0.2)
PRIOR_ROWS = 6
# Makes the scatter of the nearest 75 % of a five-dimensional normal sample that of the whole sample:
# 0.75 over the share of chi squared with seven degrees below the 75 % point with five.
_CONSISTENCY = 1.41

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_STATISTICS = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of each text; null has no words."""
    raw, starts = flat(texts)
    first, end, upto = word_places(raw, starts)

    def per_text(mark: np.ndarray) -> np.ndarray:
        before = np.concatenate(([0], np.cumsum(mark)))
        return before[starts[1:]] - before[starts[:-1]]

    hashes = word_hashes(raw, first, end)
    n = len(hashes)
    covered = np.zeros(n, dtype=bool)
    if n >= 3:
        owner = np.repeat(np.arange(len(upto) - 1), np.diff(upto))
        windows = mix(mix(mix(hashes[:-2]) + hashes[1:-1]) + hashes[2:]) + mix(owner[:-2].astype(np.uint64))
        windows = np.flatnonzero(owner[:-2] == owner[2:]), windows
        places, values = windows[0], windows[1][windows[0]]
        order = np.argsort(values, kind="stable")
        ranked = values[order]
        equal = ranked[1:] == ranked[:-1]
        twice = places[order[np.concatenate(([False], equal)) | np.concatenate((equal, [False]))]] if len(ranked) else places
        for step in range(3):
            covered[twice + step] = True
    before = np.concatenate(([0], np.cumsum(covered)))
    data = raw.tobytes()
    repeated_lines = np.zeros(len(starts) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        lines = [x for x in data[a:b].split(b"\n") if x.strip()]
        repeated_lines[i] = len(lines) - len(set(lines))
    return {
        "n_words": np.diff(upto),
        "word_chars": per_text(((raw & 0xC0) != 0x80) & ~_SPACE[raw]),
        "n_symbols": per_text(_SYMBOL[raw]),
        "n_dup_lines": repeated_lines,
        "n_repeat_words": before[upto[1:]] - before[upto[:-1]],
    }


def statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                counts = text_counts(part.column("text"))
                own = [part.column(c) for c in ("doc_id", "lang", "source")]
                yield pa.RecordBatch.from_arrays(
                    [*own, *(pa.array(counts[c], pa.int64()) for c in _COUNTS)], ["doc_id", "lang", "source", *_COUNTS]
                )

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")))
    return own.mapInArrow(run, _STATISTICS)


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    """The transformed statistics; logarithms of sizes, square roots of shares."""
    words, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [
        F.log(chars / words),
        F.log(words),
        F.sqrt(F.col("n_symbols") / (chars + 50)),
        F.sqrt(F.col("n_dup_lines") / (words / 10 + 5)),
        F.sqrt(F.col("n_repeat_words") / (words + 20)),
    ]


_X = [f"x{i}" for i in range(DIMS)]
_PAIRS = [(i, j) for i in range(DIMS) for j in range(i + 1)]


def _moments(rows: DataFrame) -> DataFrame:
    sums = [F.sum(x).alias(f"s_{x}") for x in _X]
    products = [F.sum(F.col(_X[i]) * F.col(_X[j])).alias(f"p_{i}_{j}") for i, j in _PAIRS]
    return rows.groupBy("group").agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def _estimates(moments: DataFrame) -> DataFrame:
    """group, centre (m_i), the lower triangle (l_i_j) of the inverse Cholesky factor of the scatter, and the
    logarithm of the scatter's determinant."""
    names = [f"m_{i}" for i in range(DIMS)] + [f"l_{i}_{j}" for i, j in _PAIRS] + ["log_det"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            n = rows["n"].to_numpy()[:, None]
            centre = rows[[f"s_{x}" for x in _X]].to_numpy() / n
            scatter = np.zeros((len(rows), DIMS, DIMS))
            for i, j in _PAIRS:
                scatter[:, i, j] = scatter[:, j, i] = rows[f"p_{i}_{j}"].to_numpy() / n[:, 0] - centre[:, i] * centre[:, j]
            # A multiple of the raw scatter makes up for the cut tails, and in small samples for the fitted centre.
            scatter *= (_CONSISTENCY * n / np.maximum(n - DIMS, n / 2))[:, :, None]
            least = np.square(FLOOR) + PRIOR_ROWS / n * np.square(PRIOR)
            scatter += least[:, :, None] * np.eye(DIMS)
            factor = np.linalg.inv(np.linalg.cholesky(scatter)) if len(rows) else scatter
            log_det = -2 * np.log(np.diagonal(factor, axis1=1, axis2=2)).sum(axis=1)
            columns = [*centre.T, *(factor[:, i, j] for i, j in _PAIRS), log_det]
            yield pd.DataFrame({"group": rows["group"], **dict(zip(names, columns))})

    return moments.mapInPandas(run, "group string, " + ", ".join(f"{c} double" for c in names))


def _with_distance(rows: DataFrame, estimates: DataFrame, how: str) -> DataFrame:
    """Add the squared Mahalanobis distance ``d2``."""
    near = F.broadcast(estimates) if estimates.count() <= BROADCAST_ROWS else estimates
    total = F.lit(0.0)
    for i in range(DIMS):
        total += F.pow(sum((F.col(f"l_{i}_{j}") * (F.col(_X[j]) - F.col(f"m_{j}")) for j in range(i + 1)), F.lit(0.0)), F.lit(2.0))
    return rows.join(near, "group", how).withColumn("d2", total).drop(*(c for c in estimates.columns if c != "group"))


def _grouped(rows: DataFrame, min_rows: int) -> DataFrame:
    """Name the group by which each row is judged, and in ``members`` all groups whose estimates it takes part in.
    A row is judged by its language and source, or where those have few rows by all rows of its language, or where
    that has few rows too, by all rows."""
    own = F.to_json(F.struct(F.col("lang").alias("l"), F.col("source").alias("s")), {"ignoreNullFields": "false"})
    language = F.to_json(F.struct(F.col("lang").alias("l")), {"ignoreNullFields": "false"})
    sizes = materialize(rows.groupBy(own.alias("own"), language.alias("_language")).agg(F.count(F.lit(1)).alias("_n")), "group-sizes")
    languages = sizes.groupBy("_language").agg(F.sum("_n").alias("_in_language"), F.min("_n").alias("_least"))
    narrow = (F.col("_least") < min_rows) & (F.col("_in_language") >= min_rows)
    languages = materialize(languages.select("_language", "_in_language", narrow.alias("_used")), "languages")
    few = not languages.filter(F.col("_in_language") < min_rows).isEmpty()
    none = F.array().cast("array<string>")
    members = F.concat(
        F.when(F.col("_n") >= min_rows, F.array("own")).otherwise(none),
        F.when(F.col("_used"), F.array("_language")).otherwise(none),
        F.array(F.lit("all")) if few else none,
    )
    by = F.when(F.col("_n") >= min_rows, F.col("own")).when(F.col("_in_language") >= min_rows, F.col("_language")).otherwise("all")
    named = materialize(sizes.join(languages, "_language").select("own", by.alias("group"), members.alias("members")), "groups")
    named = F.broadcast(named) if named.count() <= BROADCAST_ROWS else named
    return rows.withColumn("own", own).join(named, "own").drop("own")


def judge(docs: DataFrame, support: float = SUPPORT, steps: int | None = None, cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """doc_id, the five counts, base_failed, kept and d2 (squared distance, null where base_failed).

    Texts that fail the base rules take no part in the estimates. Null and empty texts have no words
    and fail. Null lang and source are values of their own. Every other row has a d2, however few rows there are.
    The concentration steps go on until no determinant falls, or up to ``steps``. Repeated rows are judged
    alike; an empty table gives an empty one; other columns are left out.
    """
    rows = materialize(statistics(docs).withColumn("base_failed", base_failed()), "statistics")
    passed = rows.filter(~F.col("base_failed")).select("*", *(x.alias(name) for x, name in zip(vector(), _X)))
    vectors = materialize(_grouped(passed, min_rows), "vectors")
    members = vectors.select(F.explode("members").alias("group"), *_X)
    estimates = falling = materialize(_start(members), "estimates")
    while (steps is None or steps > 0) and not falling.isEmpty():
        steps = None if steps is None else steps - 1
        placed = materialize(_with_distance(members, falling, "inner"), "distances")
        reach = placed.groupBy("group").agg(F.percentile_approx("d2", support, 10_000).alias("reach"))
        reach = materialize(reach, "reach")
        reach = F.broadcast(reach) if reach.count() <= BROADCAST_ROWS else reach
        new = materialize(_estimates(_moments(placed.join(reach, "group").filter("d2 <= reach"))), "estimates")
        before = falling.select("group", F.col("log_det").alias("_before"))
        falling = new.join(before, "group").filter(F.col("log_det") < F.col("_before") - FALL).drop("_before")
        falling = materialize(falling, "falling")
        estimates = materialize(estimates.join(falling, "group", "left_anti").unionByName(falling), "estimates")
    judged = _with_distance(vectors, estimates, "left").select(*rows.columns, "d2")
    every = judged.unionByName(rows.filter("base_failed").withColumn("d2", F.lit(None).cast("double")))
    kept = ~F.col("base_failed") & (F.col("d2") <= cutoff)
    return every.select("doc_id", *_COUNTS, "base_failed", kept.alias("kept"), "d2")


def _start(vectors: DataFrame) -> DataFrame:
    """First estimate of each group: medians and spreads of the single statistics."""
    middle = vectors.groupBy("group").agg(*(F.percentile_approx(x, [0.25, 0.5, 0.75], 10_000).alias(x) for x in _X))
    centre = [F.col(x)[1].alias(f"m_{i}") for i, x in enumerate(_X)]
    spread = [F.greatest((F.col(x)[2] - F.col(x)[0]) / 1.349, F.lit(r)) for x, r in zip(_X, FLOOR)]
    factor = [(1 / spread[i] if i == j else F.lit(0.0)).alias(f"l_{i}_{j}") for i, j in _PAIRS]
    return middle.select("group", *centre, *factor, F.lit(float("inf")).alias("log_det"))
