import hashlib
import re

from pyspark.sql import Row
from pyspark.sql import functions as F

from barlake.llm import decontamination as dec
from barlake.llm.queries import registered

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, size=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for start in range(max(1, len(w) - size + 1) if w else 0):
            grams.setdefault(tuple(w[start : start + size]), set()).add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for length in {len(g) for g in grams}:
            for start in range(len(w) - length + 1):
                if (got := grams.get(tuple(w[start : start + length]))) is not None:
                    hit |= set(range(start, start + length))
                    found |= got
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc] = (len(w), len(hit), len(found), digest, bool(hit))
    return out


LONG = "one two three four five six seven eight nine ten eleven twelve"
DOCS = [
    (1, f"Before, {LONG.upper()}! after"),
    (2, None),
    (3, ""),
    (4, "short item here; nothing else. short ITEM"),
    (5, "one two three four five six seven eight nine"),
    (6, f"{LONG} x {LONG}"),
    (7, "Élan élan"),
    (8, "word " * 3000 + LONG),
]
ITEMS = [(0, LONG), (10, "Short item"), (2, None), (3, " .. "), (4, LONG), (5, "Élan")]


def frames(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def digest(found):
    return {r[0]: tuple(r)[1:] for r in dec.hit_digest(found).collect()}


def test_brute_force_in_one_and_in_many_blocks(spark):
    docs, items = frames(spark)
    assert digest(dec.hits(docs, items)) == brute(DOCS, ITEMS)
    assert digest(dec.hits(docs, items, block_windows=2)) == brute(DOCS, ITEMS)


def test_empty_tables_and_extra_columns(spark):
    docs, items = frames(spark)
    assert digest(dec.hits(docs, items.limit(0))) == brute(DOCS, [])
    assert digest(dec.hits(docs.limit(0), items)) == {}
    wide = docs.withColumn("item_id", F.lit(1)).withColumn("starts", F.lit("x")).unionByName(
        docs.withColumn("item_id", F.lit(1)).withColumn("starts", F.lit("x")).filter("doc_id in (1, 3)")
    )
    kept = dec.drop_contaminated(wide, items)
    assert kept.columns == wide.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 3, 5]


def test_a_null_key_is_dropped_or_kept_by_its_own_hits(spark):
    docs = spark.createDataFrame([Row(doc_id=None, text=LONG), Row(doc_id=1, text="clean")], "doc_id long, text string")
    _, items = frames(spark)
    assert [r["doc_id"] for r in dec.drop_contaminated(docs, items).collect()] == [1]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {r[0]: tuple(r)[1:] for r in registered()["op8_decontamination"](spark, sf).collect()}
    assert got == brute(docs, items)
    assert any(v[-1] for v in got.values())
