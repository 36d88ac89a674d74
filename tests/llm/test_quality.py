import random

import pyarrow as pa

from tallyward.llm import quality
from tests.llm.conftest import documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, judged on the other."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = labels.collect()
    fit, judge = rows[::2], {r.doc_id: r.quality for r in rows[1::2]}
    kept = {r.doc_id: r.kept for r in quality.select_by_importance(docs, spark.createDataFrame(fit, labels.schema))[0].collect()}
    good = [kept[k] for k, q in judge.items() if q == 1]
    bad = [kept[k] for k, q in judge.items() if q == 0]
    assert sum(good) / len(good) >= 0.9
    assert sum(bad) / len(bad) <= 0.1


def test_no_labels_keep_everything(spark, no_labels):
    docs = documents(spark, [(k, f"text {k}") for k in range(20)])
    assert all(r.kept for r in quality.select_by_importance(docs, no_labels)[0].collect())


def test_kth_largest(spark, monkeypatch):
    monkeypatch.setattr(quality, "_GATHER", 4)
    draw = random.Random(3)
    values = [draw.choice([draw.gauss(0, 1), draw.gauss(0, 1) * 1e6, 2.5]) for _ in range(500)]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 2, 77, 250, 499, 500):
        assert quality.kth_largest(frame, "v", k) == sorted(values, reverse=True)[k - 1]


def test_held_out_toxic(spark):
    """A few insults in a long text are no weight in a sum over it, yet the text goes."""
    draw = random.Random(5)
    insults = ["idiot", "moron", "scum", "trash"]
    words = [f"word{k}" for k in range(2000)]
    rows, marks = [], []
    for k in range(800):
        text, toxic = draw.choices(words, k=draw.choice([30, 300, 1500])), int(k % 8 == 0)
        for _ in range(3 * toxic):
            text.insert(draw.randrange(len(text)), draw.choice(insults))
        rows.append((k, " ".join(text)))
        marks.append((k, 1, toxic))
    labels = spark.createDataFrame(marks[:400], "doc_id bigint, quality int, toxic int")
    found, model, least = quality.select_by_importance(documents(spark, rows), labels, reject_toxic=True)
    kept = {r.doc_id: r.kept for r in found.collect()}
    toxic = [kept[k] for k, _, t in marks[400:] if t]
    clean = [kept[k] for k, _, t in marks[400:] if not t]
    assert sum(toxic) <= 0.1 * len(toxic) and sum(clean) >= 0.9 * len(clean)
    again = model.drawn(pa.array([k for k, _ in rows]), pa.array([t for _, t in rows]), least)
    assert again.tolist() == [kept[k] for k, _ in rows]


def test_given_toxic(spark):
    """Fitted on half of the labels of sf0.1, judged on the other."""
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = labels.collect()
    kept = {r.doc_id: r.kept for r in quality.select_by_importance(docs, spark.createDataFrame(rows[::2], labels.schema), reject_toxic=True)[0].collect()}
    toxic = [kept[r.doc_id] for r in rows[1::2] if r.quality == 1 and r.toxic == 1]
    clean = [kept[r.doc_id] for r in rows[1::2] if r.quality == 1 and r.toxic == 0]
    assert sum(toxic) <= 0.2 * len(toxic) and sum(clean) >= 0.98 * len(clean)
