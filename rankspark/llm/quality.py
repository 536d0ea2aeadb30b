"""Quality rules: text statistics, and robust outliers among them, in built-in functions.

Per language and source, the minimum-covariance-determinant estimate is worked out: mean and
covariance of the three quarters of the texts that lie closest together.  Concentration steps
take the texts nearest by Mahalanobis distance under the estimate before, as long as that makes
the determinant smaller; they start from several estimates, and the smallest determinant that
any of them reaches wins.  A reweighted estimate from all texts within the 97.5 % distance
follows, and texts beyond ``CUTOFF`` of it are rejected.  A fixed variance is added to each
statistic (as in regularised MCD): most texts repeat nothing and hold no symbol, and without
it a single repeated line would lie infinitely far off.

A few texts say little about a covariance.  The same is worked out for each language, and a
source's covariance is the mean of both, its own weighing as many texts as it has against
``PRIOR_TEXTS``; its mean is its own.  That holds for groups of any size.

Vectors are kept as whole 1024ths, so that sums do not depend on their order, and distances
are counted in narrow classes, so that no step sorts texts: a step is one scan with partial
sums per group and class.

The statistics of a text are worked out inside its row by functions of arrays, so that no
text is shuffled.  ``_let`` binds a value for use in a lambda: written out instead, Catalyst
may put the expression into the lambda and work it out anew for each element.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window, functions as F

from rankspark.llm.tables import stored

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column) -> Column:
    """Words in windows that start at the places, which are in order."""

    def new(place: Column, i: Column) -> Column:
        following = F.get(places, i + 1)
        return F.least(F.coalesce(following - place, F.lit(WINDOW)), F.lit(WINDOW))

    return F.aggregate(F.transform(places, new), F.lit(0), lambda a, b: a + b)


def _repeated(names: Column) -> Column:
    """Words in windows whose name stands twice or more in the list of all windows."""
    with_place = F.sort_array(F.transform(names, lambda name, i: F.struct(name.alias("name"), i.alias("i"))))

    def places(ordered: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before = F.get(ordered, i - 1)["name"]
            after = F.get(ordered, i + 1)["name"]
            return F.coalesce(before == x["name"], F.lit(False)) | F.coalesce(after == x["name"], F.lit(False))

        return F.sort_array(F.transform(F.filter(ordered, twin), lambda x: x["i"]))

    return F.when(F.size(F.array_distinct(names)) == F.size(names), F.lit(0)).otherwise(
        _let(with_place, lambda ordered: _let(places(ordered), _covered))
    )


def _of_words(words: Column) -> Column:
    n = F.size(words)
    # A window is named by 64 bits of hash over its words, which is compared in one text only.
    names = F.when(
        n >= WINDOW,
        F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW))),
    ).otherwise(F.array().cast("array<long>"))
    return F.struct(
        n.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _let(names, _repeated).cast("long").alias("n_repeat_words"),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """Adds (or replaces) the columns of ``BASE``.

    A null or empty text has no words: all counts are 0 and ``base_failed`` is true.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    docs = docs.drop(*BASE)
    words = _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), _of_words)
    # As the one row of a generator, so that later filters cannot have it worked out again.
    rows = docs.select("*", F.inline(F.array(words)))
    rows = rows.select(
        *docs.columns,
        "n_words",
        "word_chars",
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed)


# ---------------------------------------------------------------- robust outliers

#: Share of the texts of a group that the estimate rests on.
SHARE = 0.75
#: Probability of a distance at which a text of a normal population is rejected.
CUTOFF = 1 - 1e-5
REWEIGHT = 0.975
#: Texts that a language's covariance weighs beside a source's own.
PRIOR_TEXTS = 50
#: Standard deviations taken for granted: word length, symbols, repeated lines, repeated words.
NOISE = (0.05, 0.5, 0.5, 0.15)
_UNIT = 1024
_CLASSES = 256  # of ln(1 + squared distance), per unit
_X = tuple(f"x{i}" for i in range(len(NOISE)))
_PAIRS = tuple(combinations_with_replacement(range(len(NOISE)), 2))


def _chi2(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def chi2_quantile(probability: float) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi2(middle, len(NOISE)) < probability else (low, middle)
    return high


def _consistency(share: float) -> float:
    """By how much the covariance of the nearest share of a normal population is too small."""
    return share / _chi2(chi2_quantile(share), len(NOISE) + 2)


def _vector(docs: DataFrame) -> DataFrame:
    """Adds the transformed statistics ``_X`` of rows with the columns of ``BASE``."""
    values = (
        "ln(greatest(word_chars, 1) / greatest(n_words, 1))",
        "log1p(100 * n_symbols / greatest(n_words, 1))",
        "log1p(n_dup_lines)",
        "asin(sqrt(n_repeat_words / greatest(n_words, 1)))",
    )
    return docs.withColumns({x: F.expr(f"bigint(round({_UNIT} * {v}))") for x, v in zip(_X, values, strict=True)})


def _text_group(column: str) -> Column:
    """Language or source as a key; null is a value of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def _distance2() -> str:
    """Squared Mahalanobis distance of the vector from the estimate beside it, as SQL."""
    off = [f"({x} / {_UNIT} - m{i})" for i, x in enumerate(_X)]
    return " + ".join(f"{1 if i == j else 2} * w{i}{j} * {off[i]} * {off[j]}" for i, j in _PAIRS)


_KEYS = ["grp", "start"]
_MEANS = [f"m{i}" for i in range(len(NOISE))]


def _inverted(rows: DataFrame, *others: str) -> DataFrame:
    """Means ``m{i}`` and covariances ``s{i}{j}``, i <= j -> ``w{i}{j}`` of the inverse, and ``logdet``.

    The sweep operator, applied to every diagonal entry, gives the inverse times -1; the entries
    by which it divides multiply to the determinant.
    """
    names = [*others, *_MEANS]

    def entry(i: int, j: int) -> str:
        return f"s{min(i, j)}{max(i, j)}"

    def swept(i: int, j: int, k: int) -> str:
        if i == j == k:
            return f"-1 / {entry(k, k)}"
        if k in (i, j):
            return f"{entry(i, j)} / {entry(k, k)}"
        return f"{entry(i, j)} - {entry(i, k)} * {entry(j, k)} / {entry(k, k)}"

    rows = rows.withColumn("logdet", F.lit(0.0))
    for k in range(len(NOISE)):
        sums = [f"{swept(i, j, k)} AS s{i}{j}" for i, j in _PAIRS]
        rows = rows.selectExpr(*names, f"logdet + ln({entry(k, k)}) AS logdet", *sums)
    return rows.selectExpr(*names, "logdet", *[f"-{entry(i, j)} AS w{i}{j}" for i, j in _PAIRS])


def _medians(counts: DataFrame, value: str) -> DataFrame:
    """(grp, dim, value, n) -> (grp, dim, median): the least value that half the texts reach."""
    own = Window.partitionBy("grp", "dim")
    so_far = own.orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    rows = counts.withColumns({"__sum": F.sum("n").over(so_far), "__all": F.sum("n").over(own)})
    return rows.where(2 * F.col("__sum") >= F.col("__all")).groupBy("grp", "dim").agg(F.min(value).alias("median"))


def _starts(vectors: DataFrame) -> DataFrame:
    """Estimates to start from, by group and ``start``.

    Medians with median deviations and no covariances; medians with the variances taken for
    granted; mean and covariance of all texts.  The determinant is that of nothing yet.
    """
    values = vectors.select("grp", F.posexplode(F.array(*_X)).alias("dim", "x"))
    counts = stored(values.groupBy("grp", "dim", "x").agg(F.count(F.lit(1)).alias("n")), "quality-values")
    middle = _medians(counts, "x").withColumnRenamed("median", "m")
    off = counts.join(middle.hint("merge"), ["grp", "dim"]).withColumn("off", F.abs(F.col("x") - F.col("m")))
    off = _medians(off.groupBy("grp", "dim", "off").agg(F.sum("n").alias("n")), "off")
    both = middle.join(off.hint("merge"), ["grp", "dim"])
    centre = [f"max(CASE WHEN dim = {i} THEN m END) / {_UNIT} AS m{i}" for i in range(len(NOISE))]
    spread = {i: f"max(CASE WHEN dim = {i} THEN median END)" for i in range(len(NOISE))}
    wide = [f"pow(1.4826D * {spread[i]} / {_UNIT}, 2) + {n**2}D AS s{i}{i}" for i, n in enumerate(NOISE)]
    plain = [f"{n**2}D AS s{i}{i}" for i, n in enumerate(NOISE)]
    none = [f"0D AS s{i}{j}" for i, j in _PAIRS if i < j]
    medians = [
        both.groupBy("grp").agg(F.lit(number).alias("start"), *map(F.expr, [*centre, *variances, *none]))
        for number, variances in enumerate((wide, plain))
    ]
    whole = _covariances(_sums(vectors.groupBy("grp").agg(*_moments()), "grp"), 1.0, "grp")
    rows = medians[0].unionByName(medians[1]).unionByName(whole.withColumn("start", F.lit(2)).drop("n"))
    return _inverted(rows, *_KEYS).withColumn("logdet", F.lit(float("inf")))


_MOMENTS = ["n", *[f"t{i}" for i in range(len(NOISE))], *[f"p{i}{j}" for i, j in _PAIRS]]


def _moments() -> list[Column]:
    """Count, sums and sums of products of the vectors."""
    sums = ["count(1)", *[f"sum({x})" for x in _X], *[f"sum({_X[i]} * {_X[j]})" for i, j in _PAIRS]]
    return [F.expr(f"{value} AS {name}") for name, value in zip(_MOMENTS, sums, strict=True)]


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    """Sums of sums, wide enough for any number of texts."""
    return rows.groupBy(*keys).agg(*[F.expr(f"sum(CAST({c} AS decimal(38,0))) AS {c}") for c in _MOMENTS])


def _covariances(moments: DataFrame, factor: float, *keys: str) -> DataFrame:
    """Sums over the texts chosen -> how many, mean and covariance."""
    means = [f"double(t{i}) / double(n) / {_UNIT} AS m{i}" for i in range(len(NOISE))]
    squares = [f"double(p{i}{j}) / double(n) / {_UNIT**2} AS p{i}{j}" for i, j in _PAIRS]
    rows = moments.selectExpr(*keys, "n", *means, *squares)
    covariances = [
        f"{factor}D * (p{i}{j} - m{i} * m{j}) + {NOISE[i] ** 2 if i == j else 0.0}D AS s{i}{j}" for i, j in _PAIRS
    ]
    return rows.selectExpr(*keys, "n", *_MEANS, *covariances)


def _concentrate(vectors: DataFrame, estimate: DataFrame) -> DataFrame:
    """One step: the estimates from the nearest share of each group."""
    class_ = F.expr(f"floor({_CLASSES} * ln(1 + {_distance2()}))")
    near = vectors.join(estimate, "grp").withColumn("class", class_).groupBy(*_KEYS, "class").agg(*_moments())
    own = Window.partitionBy(*_KEYS)
    before = own.orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumns({"__before": F.coalesce(F.sum("n").over(before), F.lit(0)), "__all": F.sum("n").over(own)})
    near = near.where(F.col("__before") < F.ceil(SHARE * F.col("__all")))
    return _inverted(_covariances(_sums(near, *_KEYS), _consistency(SHARE), *_KEYS), *_KEYS)


#: A step that makes the logarithm of the determinant smaller by less is the last.
_LEAST_GAIN = 1e-9


def _converged(vectors: DataFrame) -> DataFrame:
    """For each group the estimate of the smallest determinant that the starts lead to.

    A start takes steps as long as they make its determinant smaller; groups and starts that
    have come to their end take no part in further ones.  Subsets are finitely many and none
    comes twice, so it ends.
    """
    moving, found = stored(_starts(vectors), "quality-estimate"), []
    while not moving.isEmpty():
        new = _concentrate(vectors, moving).withColumnRenamed("logdet", "to")
        old = moving.select(*_KEYS, F.col("logdet").alias("from"))
        new = stored(new.join(old, _KEYS).withColumnRenamed("to", "logdet"), "quality-estimate")
        gain = F.col("from") - F.col("logdet") > _LEAST_GAIN
        found.append(new.drop("from"))
        moving = new.where(gain).drop("from")
    if not found:
        return moving.drop("start", "logdet")
    best = F.row_number().over(Window.partitionBy("grp").orderBy("logdet", "start"))
    rows = reduce(DataFrame.unionByName, found).withColumn("__place", best).where("__place = 1")
    return stored(rows.drop("__place", "start", "logdet"), "quality-best")


def fit(statistics: DataFrame) -> DataFrame:
    """Stored rows with ``lang``, ``source`` and ``BASE`` -> estimates by language and source."""
    rows = statistics.where(~F.col("base_failed"))
    rows = _vector(rows.withColumns({"__lang": _text_group("lang"), "__source": _text_group("source")}))
    pair, whole = F.struct("__lang", "__source"), F.struct("__lang", F.lit(None).cast("string").alias("__source"))
    vectors = stored(rows.select(F.explode(F.array(pair, whole)).alias("grp"), *_X), "quality-vectors")
    near = vectors.join(_converged(vectors), "grp").where(f"{_distance2()} <= {chi2_quantile(REWEIGHT)}D")
    final = _covariances(_sums(near.groupBy("grp").agg(*_moments()), "grp"), _consistency(REWEIGHT), "grp")
    final = stored(final.select("grp.*", *[c for c in final.columns if c != "grp"]), "quality-groups")
    shared = [F.col(f"s{i}{j}").alias(f"l{i}{j}") for i, j in _PAIRS]
    languages = final.where("__source IS NULL").select("__lang", *shared)
    both = final.where("__source IS NOT NULL").join(languages, "__lang")
    own, all_ = f"double(n) / (double(n) + {PRIOR_TEXTS})", f"{PRIOR_TEXTS} / (double(n) + {PRIOR_TEXTS})"
    mixed = [f"{own} * s{i}{j} + {all_} * l{i}{j} AS s{i}{j}" for i, j in _PAIRS]
    keys = ["__lang", "__source"]
    return stored(_inverted(both.selectExpr(*keys, *_MEANS, *mixed), *keys).drop("logdet"), "quality-final")


def judge(docs: DataFrame, estimates: DataFrame) -> DataFrame:
    """Adds ``distance2`` and ``kept`` to rows with ``lang``, ``source`` and ``BASE``."""
    names = [c for c in docs.columns if c not in ("distance2", "kept")]
    rows = _vector(docs.select(*names).withColumns({"__lang": _text_group("lang"), "__source": _text_group("source")}))
    rows = rows.join(estimates, ["__lang", "__source"], "left")
    rows = rows.select(*names, F.expr(f"CASE WHEN NOT base_failed THEN {_distance2()} END AS distance2"))
    near = F.coalesce(F.col("distance2") <= chi2_quantile(CUTOFF), F.lit(True))
    return rows.withColumn("kept", ~F.col("base_failed") & near)


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, text, lang, source) -> doc_id, ``BASE``, ``distance2`` and ``kept`` of each row.

    A text that fails a base rule has no distance.  Null languages and sources are groups of
    their own.  Repeated rows count each for itself; an empty table gives no rows; other
    columns are ignored.
    """
    rows = stored(with_statistics(docs.select("doc_id", "text", "lang", "source")).drop("text"), "quality-statistics")
    return judge(rows, fit(rows)).drop("lang", "source")


def keep(docs: DataFrame) -> DataFrame:
    """The documents that neither a base rule nor the robust distance rejects, as they are.

    Texts are stored once, with their statistics beside them, for the estimates and the verdict.
    """
    rows = docs.select("text", "lang", "source", F.struct(*docs.columns).alias("__row"))
    rows = stored(with_statistics(rows).drop("text"), "quality-statistics")
    return judge(rows, fit(rows)).where("kept").select("__row.*")
