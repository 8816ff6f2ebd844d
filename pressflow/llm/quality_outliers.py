"""Quality rules: base limits on repetition, then robust multivariate outliers by language and source.

Statistics of a text are turned into a vector whose parts are roughly normal in clean text. For each
language and source the centre and covariance of that vector are estimated by the minimum covariance
determinant: those of the three quarters of the rows whose covariance has the least determinant.
The search starts from the rows nearest the medians, and from the rows nearest the mean, and repeats
concentration steps (estimate, measure all rows, keep the nearest three quarters), none of which
raises the determinant; the start that ends lower wins. A group's estimate is drawn towards that of
its language, and that towards the one of all texts, the more the fewer rows it has; there is no size
at which the rule changes. A text whose Mahalanobis distance from its
group's centre is beyond the cut is rejected.

All of it is DataFrame operations. The vectors are stored once; each step is an aggregation that sums
up in the tasks first, so a source with most of the rows sends a row for each task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressflow.llm.support import BLANKS, stored, text_of

MIN_WORDS = 20
WINDOW = 8
#: Share of a group's rows that the estimates rest on, and concentration steps.
COVERAGE = 0.75
STEPS = 4
#: Rows at which a group's own estimate and its language's count the same; so for languages and all.
#: Ten for each part of the vector.
PRIOR_ROWS = 50
#: Quantile 0.9999 of chi-square with 5 degrees of freedom: the cut of the squared distance.
CUT = 25.74
#: Quantile 0.75 of the same, and that of 7 degrees at this point: the covariance of the nearest
#: three quarters of normal rows is this much too small.
CONSISTENCY = 0.75 / 0.5344

#: Parts of the vector: name, expression, and the standard deviation that is the least of all groups.
#: The least times the root of ``CUT`` (5.07) is what a part can reject alone in the tightest group.
#: For ``repeats`` 29 of 100 words reach that from about 400 words on, shorter texts not. A floor at which
#: a quarter of 60 words reaches it (0.067) rejected 5 of 333 good texts of sf0.01 as well.
PARTS = [
    ("word_length", "ln((word_chars + 250) / (n_words + 50))", 0.05),
    ("symbols", "sqrt(n_symbols / (n_words + 50))", 0.05),
    ("capitals", "sqrt((n_capitals + 2) / (word_chars + 100))", 0.05),
    ("dup_lines", "sqrt(n_dup_lines / (n_lines + 5))", 0.12),
    ("repeats", "sqrt(n_repeat_words / (n_words + 50))", 0.10),
]
_K = len(PARTS)
_BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that occur twice or more in the array."""
    def covered(windows):
        def starts(ranked):
            def again(x, i):
                return (((i > 0) & (F.get(ranked, i - 1)["h"] == x["h"]))
                        | F.coalesce(F.get(ranked, i + 1)["h"] == x["h"], F.lit(False)))

            return F.sort_array(F.transform(F.filter(ranked, again), lambda x: x["i"]))

        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n"))
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(
            _let(ranked, starts), zero,
            lambda a, p: F.struct(p.alias("last"),
                                  (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")),
            lambda a: a["n"])

    def counted(hashes):
        windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1),
                              lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
        return _let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0)
                    .otherwise(covered(h)))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= WINDOW, 0).otherwise(_let(hashed, counted))


def statistics(text: str | Column) -> Column:
    """A struct of the counts of a text; a null text counts as one without words.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, for the vector
    ``n_lines`` (with a word) and ``n_capitals``, and ``failed``: whether the text fails the base.
    """
    def failed(repeats, n_words):
        return (n_words < MIN_WORDS) | (100 * repeats > 30 * n_words)

    def counts(value):
        words = F.filter(F.split(value, BLANKS), lambda w: w != "")
        lines = F.filter(F.split(value, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

        def of(words_):
            return _let(_repeat_words(words_), lambda repeats: _let(lines, lambda lines_: F.struct(
                F.size(words_).cast("long").alias("n_words"),
                F.length(F.regexp_replace(value, BLANKS, F.lit(""))).cast("long").alias("word_chars"),
                F.regexp_count(value, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(lines_) - F.size(F.array_distinct(lines_))).cast("long").alias("n_dup_lines"),
                repeats.cast("long").alias("n_repeat_words"),
                F.size(lines_).cast("long").alias("n_lines"),
                F.regexp_count(value, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
                failed(repeats, F.size(words_)).alias("failed"))))

        return _let(words, of)

    return _let(text_of(text), counts)


def vector(counts: str) -> list[Column]:
    """The parts of the vector of a struct of counts."""
    names = ["word_chars", "n_words", "n_symbols", "n_capitals", "n_dup_lines", "n_lines", "n_repeat_words"]
    parts = []
    for name, expression, _ in PARTS:
        for column in names:
            expression = expression.replace(f"{column} ", f"{counts}.{column} ")
        parts.append(F.expr(expression).alias(name))
    return parts


def _distance(x: list[Column], centre: list[Column], lower: list[list[Column]]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the Cholesky factor.

    Each solved part is computed once and handed on in an array.
    """
    def solve(i: int, solved: Column | None) -> Column:
        rest = x[i] - centre[i]
        for j in range(i):
            rest = rest - lower[i][j] * F.element_at(solved, j + 1)
        part = rest / lower[i][i]
        array = F.array(part) if solved is None else F.concat(solved, F.array(part))
        if i == _K - 1:
            return F.aggregate(array, F.lit(0.0), lambda a, z: a + z * z)
        return _let(array, lambda done: solve(i + 1, done))

    return solve(0, None)


def _estimate(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Centre ``c_i``, covariance ``s_ij`` and its factor of the rows of each group; see ``_factored``."""
    names = [name for name, _, _ in PARTS]
    moments = [F.avg(n).alias(f"c_{i}") for i, n in enumerate(names)]
    moments += [F.covar_pop(names[i], names[j]).alias(f"s_{i}{j}") for i in range(_K) for j in range(i + 1)]
    return _factored(rows.groupBy(*keys).agg(*moments))


def _factored(found: DataFrame) -> DataFrame:
    """``found`` with the Cholesky factor ``l_ij`` of its covariance ``s_ij`` and the log determinant."""
    for i in range(_K):
        # the floor is added to the variances, so the covariance always has a factor
        for j in range(i + 1):
            value = F.col(f"s_{i}{j}") * CONSISTENCY + (F.lit(PARTS[i][2] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                value = value - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
            value = F.sqrt(F.greatest(value, F.lit(1e-12))) if i == j else value / F.col(f"l_{j}{j}")
            found = found.withColumn(f"l_{i}{j}", value)
    logs = [F.log(F.col(f"l_{i}{i}")) for i in range(_K)]
    return found.withColumn("log_det", sum(logs[1:], logs[0]))


#: Groups whose estimates are broadcast, some 0.7 KB each.
SENT_GROUPS = 10_000
#: Group of all rows; the ids of languages end in binary 10, those of a language's sources in 01.
_ALL = 0


def _salts(group_id: Column) -> Column:
    """Parts that the rows of a group are spread over when they meet something of their group.

    Known from the level that the id names, so rows and estimates agree without counting first: all
    rows, a language's, a source's.
    """
    return (F.when(group_id == _ALL, 256).when(group_id.bitwiseAND(F.lit(3)) == 2, 64).otherwise(32))


def _salted(rows: DataFrame) -> DataFrame:
    """``rows`` with ``salt``, dealt in turn, so equal rows are spread as well."""
    return rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), _salts(F.col("group_id"))).cast("int"))


def _copied(groups: DataFrame) -> DataFrame:
    """``groups``, one row each, with a copy for every ``salt`` that their rows can have."""
    return groups.withColumn("salt", F.explode(F.sequence(F.lit(0), _salts(F.col("group_id")) - 1)))


def _met(rows: DataFrame, groups: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    """``rows`` with what ``groups`` has of their group: broadcast if these are ``few``, or else copied
    for every ``salt`` and merged.

    It is not left to Spark, which sizes copies as if each group had one, and rows by their packed
    files: either would go through the driver at many times its estimate.
    """
    if few:
        return rows.join(F.broadcast(groups), "group_id", how)
    return rows.join(_copied(groups).hint("merge"), ["group_id", "salt"], how)


def _measured(rows: DataFrame, estimates: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """``rows`` with ``d2``, their squared distance in their group's estimate."""
    x = [F.col(name) for name, _, _ in PARTS]
    lower = [[F.col(f"l_{i}{j}") for j in range(i + 1)] for i in range(_K)]
    joined = _met(rows, estimates, few)
    return joined.select(*(rows[c] for c in rows.columns),
                         _distance(x, [F.col(f"c_{i}") for i in range(_K)], lower).alias("d2"))


def _nearest(measured: DataFrame, keys: list[str], few: bool) -> DataFrame:
    """The share ``COVERAGE`` of each group's rows with the least ``d2``, ties included."""
    radius = measured.groupBy(*keys).agg(
        F.percentile_approx("d2", COVERAGE, 10_000).alias("radius"))
    return _met(measured, radius, few).where("d2 <= radius").drop("d2", "radius")


def estimates(vectors: DataFrame, name: str, few: bool) -> DataFrame:
    """Minimum-covariance-determinant estimate of each ``group_id`` of ``vectors``.

    ``vectors`` holds ``group_id``, ``salt`` and the parts. One row for each group, which are ``few``
    or not. What rows are joined with is broadcast or copied for every salt, so no group's rows meet
    in one task.
    """
    keys = ["group_id"]
    names = [n for n, _, _ in PARTS]
    medians = vectors.groupBy(*keys).agg(
        *(F.percentile_approx(n, [0.25, 0.5, 0.75], 10_000).alias(f"q_{n}") for n in names))
    spread = [F.greatest((F.col(f"q_{n}")[2] - F.col(f"q_{n}")[0]) / 1.349, F.lit(floor))
              for n, _, floor in PARTS]
    near_median = _met(vectors, medians, few).select(
        *(vectors[c] for c in vectors.columns),
        sum(((F.col(n) - F.col(f"q_{n}")[1]) / s) ** 2
            for n, s in zip(names, spread, strict=True)).alias("d2"))
    near_mean = _measured(vectors, stored(_estimate(vectors, keys), f"{name}-mean"), keys, few)
    ends = []
    for start, measured in (("median", near_median), ("mean", near_mean)):
        for step in range(STEPS):
            found = stored(_estimate(_nearest(measured, keys, few), keys), f"{name}-{start}-{step}")
            measured = _measured(vectors, found, keys, few)
        ends.append(found)
    values = [c for c in ends[0].columns if c not in keys]
    return ends[0].union(ends[1]).groupBy(*keys).agg(
        F.min_by(F.struct(*values), "log_det").alias("e")).select(*keys, "e.*")


def _language_of(lang: str | Column) -> Column:
    return F.xxhash64(lang).bitwiseAND(F.lit(-4)).bitwiseOR(F.lit(2))


def _group_of(lang: str | Column, source: str | Column) -> Column:
    return F.xxhash64(lang, source).bitwiseAND(F.lit(-4)).bitwiseOR(F.lit(1))


def _shrunk(sizes: DataFrame, found: DataFrame) -> DataFrame:
    """Estimates by ``group_id``, each drawn towards its language's, and that towards all rows'.

    ``sizes`` has ``group_id``, ``lang_id`` and the rows ``n`` that pass; ``found`` has the estimates
    of groups, languages and all.
    """
    names = [c for c in found.columns if c.startswith(("c_", "s_"))]
    own, language, whole = (found.select(F.col("group_id").alias(key), F.struct(*names).alias(level))
                            for key, level in (("group_id", "own"), ("lang_id", "language"), ("all_id", "whole")))
    of_language = sizes.groupBy("lang_id").agg(F.sum("n").alias("lang_n"))
    joined = sizes.join(of_language, "lang_id").withColumn("all_id", F.lit(_ALL).cast("bigint")) \
        .join(own, "group_id").join(language, "lang_id").join(whole, "all_id")

    def between(n, value, parent):
        return (F.col(n) * value + PRIOR_ROWS * parent) / (F.col(n) + PRIOR_ROWS)

    return _factored(joined.select("group_id", *(
        between("n", F.col("own")[c], between("lang_n", F.col("language")[c], F.col("whole")[c])).alias(c)
        for c in names)))


def _fitted(rows: DataFrame) -> DataFrame:
    """Estimates by ``group_id`` of stored rows with ``group_id``, ``lang_id`` and the counts ``s``."""
    passed = rows.where("NOT s.failed")
    sizes = stored(passed.groupBy("group_id", "lang_id").agg(F.count("*").alias("n")), "group-sizes")
    levels = F.explode(F.array("group_id", "lang_id", F.lit(_ALL).cast("bigint")))
    names = [name for name, _, _ in PARTS]
    vectors = stored(_salted(passed.select("group_id", "lang_id", *vector("s"))
                             .select(levels.alias("group_id"), *names)), "vectors")
    few = sizes.count() <= SENT_GROUPS
    return stored(_shrunk(sizes, stored(estimates(vectors, "mcd", few), "estimates")), "groups")


def _judged(rows: DataFrame, fitted: DataFrame) -> DataFrame:
    """``rows`` with ``d2``, beyond every cut if the base is failed, and whether they are ``kept``.

    The verdict is one comparison with an estimate, which no optimizer can move to before the join
    and compute the counts for once more. A group without estimate has no row that passed the base.
    """
    lower = [[F.col(f"l_{i}{j}") for j in range(i + 1)] for i in range(_K)]
    d2 = _distance(vector("s"), [F.col(f"c_{i}") for i in range(_K)], lower)
    far = F.when(F.col("s.failed"), float("inf")).otherwise(0.0)
    joined = _met(_salted(rows), fitted, fitted.count() <= SENT_GROUPS, "left")
    return joined.select(*(rows[c] for c in rows.columns),
                         F.greatest(F.coalesce(d2, F.lit(float("inf"))), far).alias("d2")) \
        .withColumn("kept", F.col("d2") <= CUT)


def _rows(df: DataFrame, keep: Column, text: str, lang: str, source: str) -> DataFrame:
    return df.select(keep.alias("row"), _group_of(F.col(lang), F.col(source)).alias("group_id"),
                     _language_of(F.col(lang)).alias("lang_id"), statistics(text).alias("s"))


def quality_verdicts(df: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                     source: str = "source") -> DataFrame:
    """Id column, the base counts, ``base_failed``, ``kept`` and ``distance2`` of each row.

    A row that fails the base has no distance. Null languages and sources are a group like any
    other; a null or empty text fails the base; repeated rows are judged each. Estimates of groups are
    drawn towards their language's by ``PRIOR_ROWS``, at every size. An empty table gives an empty table; other columns are left out.
    """
    rows = stored(_rows(df, F.struct(F.col(doc_id)), text, lang, source), "counts")
    judged = _judged(rows, _fitted(rows))
    return judged.select(F.col("row")[doc_id].alias(doc_id), *(F.col("s")[c].alias(c) for c in _BASE),
                         F.col("s.failed").alias("base_failed"), "kept",
                         F.when(~F.col("s.failed"), F.col("d2")).alias("distance2"))


def kept_documents(df: DataFrame, text: str = "text", lang: str = "lang",
                   source: str = "source") -> DataFrame:
    """The rows of ``df`` that pass, with all their columns and no others; see ``quality_verdicts``.

    The text is read twice, once for the estimates and once for the verdict, and never shuffled
    while there are no more than ``SENT_GROUPS`` groups.
    """
    counts = stored(_rows(df, F.lit(0), text, lang, source).drop("row"), "counts")
    fitted = _fitted(counts)
    rows = _rows(df, F.struct(*(F.col(f"`{c}`") for c in df.columns)), text, lang, source)
    return _judged(rows, fitted).where("kept").select("row.*")
