"""Quality rules: text statistics and robust multivariate outliers (operator 10).

Everything here is DataFrame expressions. The base rules reject texts that are short or repeat
themselves. What passes them is judged by the minimum covariance determinant: per language and
source (per language where a source has few documents), location and covariance of the
transformed statistics are estimated from the ``SHARE`` of documents that lie closest together,
found by concentration steps from medians and quartiles; documents at a large Mahalanobis
distance are rejected.

The transformed statistics are whole numbers (units of 1/``UNIT``), so that sums of them and of
their products are exact and do not depend on the order of rows, and quantiles come from
counts of whole numbers. A group never meets in one task: sums are partial aggregates, and the joins with a
group's estimate are spread over ``SALTS`` tasks.
Distances within a text's statistics use 64-bit hashes of three-word windows.

Nulls: a null text has no words; a null language or source is the group of the empty name.
Rows are judged one by one, so repeated rows and ids get equal verdicts. Groups with fewer than
``LEAST`` documents even per language reject nothing beyond the base rules.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from barlake.functions.parsing import with_parsed
from barlake.llm.text import column
from barlake.storage import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
NOT_SPACE = r"[^\x20\x09-\x0D]"

UNIT = 1024
SHARE = 0.75
STEPS = 4
LEAST = 50
# A standard deviation, given the statistics before, counts as this at least, so that a statistic most
# texts have at zero (symbols, repeated lines) does not make the covariance singular. The values are the
# statistics' resolution: by itself, one repeated line or one repeated three-word window in a text of 50 words,
# one symbol in a hundred characters or the sampling error of the mean of 50 words stays within the cutoff.
FLOORS = {"word_length": 0.054, "symbols": 0.02, "dup_lines": 0.03, "repeats": 0.072}
FEATURES = list(FLOORS)
# Squared distance that a text may have: the 0.9999 quantile of chi-square with four degrees.
CUTOFF = 23.5
# Variance of normal data over that of its central 75 % (four dimensions).
CONSISTENCY = 1.49

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _repeat_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """Words covered by three-word windows that occur at least twice in the text."""
    w, n = F.col(words), F.size(words)
    triple = F.transform(
        F.sequence(F.lit(0), n - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    df = df.withColumn("__h", F.when(n >= 3, triple).otherwise(F.array().cast("array<bigint>")))
    # Most texts repeat nothing: only the others are sorted.
    placed = F.array_sort(F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    df = df.withColumn(
        "__s", F.when(F.size(F.array_distinct("__h")) < F.size("__h"), placed)
    )
    s = F.col("__s")

    def twice(e: Column, i: Column) -> Column:
        before = (i > 0) & (F.get(s, i - 1)["h"] == e["h"])
        after = (i < F.size(s) - 1) & (F.get(s, i + 1)["h"] == e["h"])
        return before | after

    places = F.array_sort(F.transform(F.filter(s, twice), lambda e: e["p"]))
    df = df.withColumn("__p", places)
    p = F.col("__p")
    inner = F.when(
        F.size(p) >= 2,
        F.aggregate(
            F.sequence(F.lit(1), F.size(p) - 1),
            F.lit(0),
            lambda total, i: total + F.least(F.lit(3), F.get(p, i) - F.get(p, i - 1)),
        ),
    ).otherwise(0)
    covered = F.when(F.size(p) > 0, inner + 3).otherwise(0)
    return df.withColumn(out, F.coalesce(covered, F.lit(0)).cast("long")).drop("__h", "__s", "__p")


def with_statistics(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the five counts of each text, their names after ``prefix``."""
    text = F.coalesce(column(text_col), F.lit(""))
    df = docs.withColumn("__w", F.array_remove(F.split(text, SPACE), ""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE))
    df = df.withColumn("__l", lines)
    df = _repeat_words(df, "__w", "__repeated")
    counts = F.struct(
        F.size("__w").cast("long").alias("n_words"),
        F.char_length(F.translate(text, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
        F.col("__repeated").alias("n_repeat_words"),
    )
    # A generator, so that no filter copies these expressions below itself.
    df = with_parsed(df, "__counts", counts)
    return df.select(
        *(column(c) for c in docs.columns), *(F.col(f"__counts.{n}").alias(f"{prefix}{n}") for n in STATISTICS)
    )


def base_failed(prefix: str = "") -> Column:
    n, repeated = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < 50) | (100 * repeated > 50 * n)


def features(prefix: str = "") -> dict[str, Column]:
    """The transformed statistics as whole numbers; only for rows that have words."""

    def of(name: str) -> Column:
        return F.col(f"{prefix}{name}").cast("double")

    n = F.greatest(of("n_words"), F.lit(1.0))
    values = {
        "word_length": F.log(1 + of("word_chars") / n),
        "symbols": F.sqrt(of("n_symbols") / F.greatest(of("word_chars"), F.lit(1.0))),
        "dup_lines": F.sqrt(of("n_dup_lines") / n),
        "repeats": F.sqrt(of("n_repeat_words") / n),
    }
    return {f"x_{k}": F.round(v * UNIT).cast("long") for k, v in values.items()}


def _groups(lang_col: str, source_col: str) -> list[Column]:
    return [
        F.coalesce(column(lang_col).cast("string"), F.lit("")).alias("g_lang"),
        F.coalesce(column(source_col).cast("string"), F.lit("")).alias("g_source"),
    ]


KEYS = ["level", "g_lang", "g_source"]
# Tasks over which the rows of one group are spread.
SALTS = 64


def _quantiles(counts: DataFrame, by: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """Smallest value that has at least each share of the rows at or below it, from counts."""
    upto = Window.partitionBy(*by).orderBy(value)
    whole = Window.partitionBy(*by)
    ranked = counts.withColumns({"__upto": F.sum("n").over(upto), "__all": F.sum("n").over(whole)})
    return ranked.groupBy(*by).agg(
        *(
            F.min(F.when(F.col("__upto") >= share * F.col("__all"), F.col(value))).alias(name)
            for name, share in shares.items()
        )
    )


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: short lineage that no lost executor can break."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _start(rows: DataFrame) -> DataFrame:
    """Per group: medians as location, quartile distances as scales, no correlation."""
    long = rows.select(
        *KEYS, F.explode(F.array(*(F.struct(F.lit(f).alias("f"), F.col(f"x_{f}").alias("v")) for f in FEATURES))).alias("e")
    ).select(*KEYS, "e.f", "e.v")
    counts = long.groupBy(*KEYS, "f", "v").agg(F.count("*").alias("n"))
    q = _quantiles(counts, [*KEYS, "f"], "v", {"lo": 0.25, "mid": 0.5, "hi": 0.75})
    columns = []
    for f in FEATURES:
        here = F.col("f") == f
        columns.append(F.max(F.when(here, F.col("mid"))).cast("double").alias(f"m_{f}"))
        scale = (F.col("hi") - F.col("lo")) / 1.349
        columns.append(F.greatest(F.max(F.when(here, scale)), F.lit(FLOORS[f] * UNIT)).alias(f"l_{f}_{f}"))
    zeros = {f"l_{a}_{b}": F.lit(0.0) for i, a in enumerate(FEATURES) for b in FEATURES[:i]}
    return q.groupBy(*KEYS).agg(*columns).withColumns(zeros)


def distance(prefix: str = "x_") -> Column:
    """Squared Mahalanobis distance, by forward substitution in the Cholesky factor."""
    solved: dict[str, Column] = {}
    for i, a in enumerate(FEATURES):
        rest = F.col(f"{prefix}{a}") - F.col(f"m_{a}")
        for b in FEATURES[:i]:
            rest = rest - F.col(f"l_{a}_{b}") * solved[b]
        solved[a] = rest / F.col(f"l_{a}_{a}")
    return reduce(lambda x, y: x + y, (y * y for y in solved.values()))


def _estimate(subset: DataFrame, inflate: float) -> DataFrame:
    """Location and Cholesky factor of the covariance of each group."""
    pairs = [(a, b) for i, a in enumerate(FEATURES) for b in FEATURES[: i + 1]]
    sums = subset.groupBy(*KEYS).agg(
        F.count("*").alias("n"),
        *(F.sum(f"x_{f}").alias(f"s_{f}") for f in FEATURES),
        *(F.sum(F.col(f"x_{a}") * F.col(f"x_{b}")).alias(f"p_{a}_{b}") for a, b in pairs),
    )
    df = sums.withColumns({f"m_{f}": F.col(f"s_{f}") / F.col("n") for f in FEATURES})
    covariances = {}
    for a, b in pairs:
        covariances[f"c_{a}_{b}"] = inflate * (F.col(f"p_{a}_{b}") / F.col("n") - F.col(f"m_{a}") * F.col(f"m_{b}"))
    df = df.withColumns(covariances)
    for j, b in enumerate(FEATURES):
        for a in FEATURES[j:]:
            rest = F.col(f"c_{a}_{b}")
            for k in FEATURES[:j]:
                rest = rest - F.col(f"l_{a}_{k}") * F.col(f"l_{b}_{k}")
            pivot = F.sqrt(F.greatest(rest, F.lit((FLOORS[a] * UNIT) ** 2)))
            df = df.withColumn(f"l_{a}_{b}", pivot if a == b else rest / F.col(f"l_{b}_{b}"))
    return df.select(*KEYS, "n", *(f"m_{f}" for f in FEATURES), *(f"l_{a}_{b}" for a, b in pairs))


def _salted(groups: DataFrame) -> DataFrame:
    """A copy of every group's row for each salt, so that a large group's rows meet it in many tasks."""
    return groups.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _closest(rows: DataFrame, estimate: DataFrame, share: float) -> DataFrame:
    """The share of each group's rows that lies closest, ties at the border included."""
    scored = rows.join(_salted(estimate.drop("n")), [*KEYS, "__salt"]).withColumn(
        "__d", F.floor(F.log2(1 + distance()) * 64).cast("int")
    )
    counts = scored.groupBy(*KEYS, "__d").agg(F.count("*").alias("n"))
    border = _quantiles(counts, KEYS, "__d", {"__border": share})
    return scored.select(*rows.columns, "__d").join(_salted(border), [*KEYS, "__salt"]).filter("__d <= __border")


def estimates(stats: DataFrame, share: float = SHARE, steps: int = STEPS, least: int = LEAST) -> DataFrame:
    """Location and Cholesky factor per group; ``stats`` has ``g_lang``, ``g_source`` and the counts.

    ``level`` 0 are language and source, 1 the language alone (its ``g_source`` is empty).
    """
    passed = stats.filter(~base_failed()).select("g_lang", "g_source", *(c.alias(n) for n, c in features().items()))
    levels = F.explode(
        F.array(
            F.struct(F.lit(0).alias("level"), F.col("g_source").alias("s")),
            F.struct(F.lit(1).alias("level"), F.lit("").alias("s")),
        )
    ).alias("e")
    rows = passed.select("g_lang", levels, *features()).select(
        F.col("e.level").alias("level"), "g_lang", F.col("e.s").alias("g_source"), *features()
    )
    # The salts are fixed by writing them; they only say which task sees a row.
    rows = _kept(rows.withColumn("__salt", F.floor(F.rand(1) * SALTS).cast("int")), "quality-rows")
    estimate = _kept(_start(rows), "quality-start").withColumn("n", F.lit(None).cast("long"))
    for _ in range(steps):
        estimate = _kept(_estimate(_closest(rows, estimate, share), CONSISTENCY), "quality-step")
    return estimate.filter(F.col("n") >= share * least)


def with_verdict(stats: DataFrame, estimate: DataFrame, prefix: str = "", out: str = "kept", cutoff: float = CUTOFF) -> DataFrame:
    """Add the verdict: false for rows the base rules reject or that lie beyond the cutoff."""
    columns = stats.columns
    names = [c for c in estimate.columns if c not in KEYS]
    own = estimate.filter("level = 0").select(
        F.col("g_lang").alias("__lang0"), F.col("g_source").alias("__source0"), F.struct(*names).alias("__own")
    )
    language = estimate.filter("level = 1").select(
        F.col("g_lang").alias("__lang1"), F.struct(*names).alias("__language")
    )
    joined = stats.join(own, (F.col("g_lang") == F.col("__lang0")) & (F.col("g_source") == F.col("__source0")), "left")
    joined = joined.join(language, F.col("g_lang") == F.col("__lang1"), "left")
    joined = joined.withColumn("__e", F.coalesce("__own", "__language"))
    joined = joined.withColumns({n: F.col("__e")[n] for n in names}).withColumns(
        {f"x_{k.removeprefix('x_')}": v for k, v in features(prefix).items()}
    )
    near = F.coalesce(distance() <= cutoff, F.lit(True))
    return joined.select(*(column(c) for c in columns), (~base_failed(prefix) & near).alias(out))


def judge(
    docs: DataFrame,
    key_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
) -> DataFrame:
    """Per document row: ``key``, the five counts, ``base_failed`` and ``kept``."""
    rows = docs.select(column(key_col).alias("key"), *_groups(lang_col, source_col), column(text_col).alias("text"))
    stats = _kept(with_statistics(rows).drop("text"), "quality-stats")
    judged = with_verdict(stats, estimates(stats))
    return judged.select("key", *STATISTICS, base_failed().alias("base_failed"), "kept")


def filter_documents(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source"
) -> DataFrame:
    """The documents that pass, all their columns unchanged."""
    groups = _groups(lang_col, source_col)
    row = F.struct(*(column(c) for c in docs.columns))
    whole = with_statistics(docs.select(row.alias("__row"), *groups, column(text_col).alias("__text")), "__text", "q_")
    # Rows are written with their statistics, which no text is read for again.
    whole = _kept(whole.drop("__text"), "quality-rows-and-stats")
    stats = whole.select("g_lang", "g_source", *(F.col(f"q_{n}").alias(n) for n in STATISTICS))
    judged = with_verdict(whole, estimates(stats), "q_", "__kept").filter("__kept")
    return judged.select(*(F.col("__row")[c].alias(c) for c in docs.columns))
