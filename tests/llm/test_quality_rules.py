import collections
import random
import re

from pyspark.sql import functions as F

from barlake.llm import quality_rules as rules
from barlake.llm.queries import registered

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    triples = [tuple(w[i : i + 3]) for i in range(n - 2)]
    count, covered = collections.Counter(triples), set()
    for i, t in enumerate(triples):
        if count[t] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (n, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed)


ODD = [None, "", "  ", "\n\n", "a b a b a b", "x\x0by\x0cz", "a b é\U0001f600 #<>|", "p q\np q\n\np q \n", "aa a", "a a a"]


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def corpus(seed=1, n=300):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800)]
    rows = []
    for i in range(n):
        text = " ".join(rng.choices(words, k=rng.randint(60, 400)))
        if i % 10 == 3:
            text = " ".join(w + "###" for w in text.split())
        source = "hot" if i % 3 else f"s{i % 2}"
        rows.append((i, text, "en" if i % 5 else None, source if i % 7 else None))
    return rows


def test_statistics_match_brute_force(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choices("ab \n#", k=rng.randint(0, 400))) for _ in range(150)]
    texts.append("w " * 30_000 + "tail of the text " * 5)
    got = rules.judge(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    assert {r["key"]: tuple(r)[1:7] for r in got} == {i: brute(t) for i, t in enumerate(texts)}


def test_outliers_go_and_clean_documents_stay(spark):
    got = {r["key"]: r for r in rules.judge(table(spark, corpus())).collect()}
    assert {k for k, r in got.items() if not r["kept"]} == set(range(3, 300, 10))
    assert not any(r["base_failed"] for r in got.values())


def test_the_order_and_split_of_rows_do_not_matter(spark):
    docs = table(spark, corpus(2))
    first = sorted(map(tuple, rules.judge(docs).collect()))
    again = sorted(map(tuple, rules.judge(docs.orderBy(F.desc("doc_id")).repartition(7)).collect()))
    assert first == again


def test_few_documents_reject_nothing_beyond_the_base_rules(spark):
    rows = corpus(4, 20)
    assert all(r["kept"] for r in rules.judge(table(spark, rows)).collect())


def test_filter_keeps_columns_rows_and_repeats(spark):
    rows = corpus()
    docs = table(spark, rows + rows[:31]).withColumns({"n_words": F.lit("x"), "kept": F.lit(1), "level": F.lit(2)})
    kept = rules.filter_documents(docs)
    assert kept.columns == docs.columns
    ids = collections.Counter(r["doc_id"] for r in kept.collect())
    assert ids == {i: 1 + (i < 31) for i in range(300) if i % 10 != 3}
    assert rules.filter_documents(docs.limit(0)).collect() == []
    assert rules.judge(docs.limit(0)).collect() == []


def planted(kind, words, rng):
    """A text of 300 words in lines of ten that is off in one statistic alone."""
    w = rng.choices(words, k=300)
    if kind == "repeats":
        # Half a hundred words once more, at other places of their lines.
        w[155:205] = w[2:52]
    if kind == "symbols":
        w = [x + "#" if i % 6 == 0 else x for i, x in enumerate(w)]
    if kind == "word_length":
        w = [x + x[: len(x) * 3 // 4] for x in w]
    lines = [" ".join(w[i : i + 10]) for i in range(0, 300, 10)]
    if kind == "dup_lines":
        # Lines of two words: too short for a repeated window of their own.
        lines = [line for i, line in enumerate(lines) if i % 3] + [
            x for i in range(20) for x in (f"{w[5]} {w[6]}", " ".join(rng.choices(words, k=5)))
        ]
    return "\n".join(lines)


def test_an_outlier_of_each_statistic_alone_goes(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800)]
    kinds = rules.FEATURES
    rows = [(i, planted(None, words, rng), "en", "s") for i in range(200)]
    rows += [(200 + i, planted(k, words, rng), "en", "s") for i, k in enumerate(kinds)]
    got = {r["key"]: r for r in rules.judge(table(spark, rows)).collect()}
    assert not any(got[200 + i]["base_failed"] for i in range(len(kinds)))
    assert {k for k, r in got.items() if not r["kept"]} == {200 + i for i in range(len(kinds))}


def test_equal_statistics_leave_the_covariance_regular(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(800)]
    rows = []
    for i in range(120):
        # Repeated lines and repeated windows grow together.
        lines = [" ".join(rng.choices(words, k=10)) for _ in range(30)]
        rows.append((i, "\n".join(lines + lines[: 4 + i % 6]), "en", "s"))
    assert all(r["kept"] for r in rules.judge(table(spark, rows)).collect())


def test_no_python_in_the_plan(spark):
    plan = rules.judge(table(spark, corpus()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "SortAggregate" not in plan


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in registered()["op10_quality_rules"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        row = got[doc["doc_id"]]
        assert tuple(row)[1:7] == brute(doc["text"])
        assert not (row["kept"] and row["base_failed"])
