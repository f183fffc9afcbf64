import os
import random
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def table(spark):
    """documents-like table from (doc_id, text) rows, with extra columns whose names clash with
    names that the operators use inside."""
    def make(rows, lang=None):
        data = [(d, t, (lang or {}).get(d), "src", len(t or "")) for d, t in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
        for c in ("rid", "th", "n", "cid", "kept", "rank", "score", "shard", "cell", "bucket", "_id", "_th", "_row", "window"):
            df = df.withColumn(c, F.lit(7))
        return df
    return make


@pytest.fixture(scope="session")
def corpus():
    """Small corpus with copies, near copies, shared passages, nulls, empty, tiny and long texts,
    ties and repeated rows."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 7)))
    text = lambda n: [word() for _ in range(n)]
    rows, passage, base = [], text(70), text(200)
    for i in range(60):
        rows.append((i * 3, " ".join(text(rnd.randint(5, 120)))))
    for i in range(12):                                        # near copies of one text
        w = list(base)
        for _ in range(rnd.randint(0, 6)):
            w[rnd.randrange(len(w))] = word()
        rows.append((1000 - i, "\n".join(w)))
    for i in range(15):                                        # one passage in many texts, sometimes cut
        cut = passage[rnd.randint(0, 15):rnd.choice([70, 70, 60])]
        rows.append((500 + i, " ".join(text(20) + cut + text(rnd.randint(0, 20)))))
    rows += [(2000 + i, "Same Text in every copy\tof it") for i in range(25)]
    rows += [(2100, "SAME text in every copy of it"), (3000, None), (3001, ""), (3002, " \n\t "), (3003, "one"), (3004, "One"),
             (3005, "two words"), (3006, "x " * 3000), (3007, "x " * 2990), (3008, "word " * 400 + "end"),
             (4000, "repeated row here"), (4000, "repeated row here"), (4001, " ".join(base)), (4001, " ".join(passage)),
             (None, " ".join(base)), (None, None), (3010, " ".join(text(5000))), (3011, "émile Ünï ①②  wide space ÀÉ")]
    return rows
