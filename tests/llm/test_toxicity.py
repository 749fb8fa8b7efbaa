import numpy as np
import zstandard
from pyspark.sql import functions as F

from tests.llm.helpers import documents, words
from tickloom.llm.queries import QUERIES
from tickloom.llm.toxicity import distances, fit_model, fit_toxicity, score_toxicity, train_dictionaries, windows

BAD = ["vilest", "rotten", "wretched"]


def text_of(i, toxic):
    body = words(i, 60)
    if toxic:
        for place in range(3, 60, 7):
            body[place] = BAD[(i + place) % 3]
    return " ".join(body)


def labelled(spark, count=240):
    rows = [(i, text_of(i, i % 4 == 0)) for i in range(count)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(count)], "doc_id long, toxic int")
    return documents(spark, rows), labels


def test_windows_cover_the_text():
    text = " ".join(words(1, 100))
    assert b" ".join(w.strip() for w in windows(text)).decode() == text
    assert list(windows(None)) == list(windows("")) == list(windows("!!! ..")) == []


def test_dictionaries_hold_what_is_peculiar():
    plain, loaded = train_dictionaries([text_of(i, True) for i in range(40)], [text_of(i + 900, False) for i in range(80)])
    assert all(w.encode() in loaded and w.encode() not in plain for w in BAD)
    found = distances([text_of(2000, True), text_of(2001, False), None], plain, loaded)
    assert found[0, 0] > found[1, 0] and not found[2].any()


def test_copies_teach_nothing_private():
    copies = [text_of(5, False)] * 50
    plain, loaded = train_dictionaries(copies, [text_of(i + 900, False) for i in range(80)])
    assert loaded == b""


def test_scores(spark):
    docs, labels = labelled(spark)
    model = fit_toxicity(docs, labels)
    rows = [(1, text_of(5000, True)), (2, text_of(5001, False)), (3, None), (4, ""), (5, (text_of(5002, False) + " ") * 300)]
    found = score_toxicity(documents(spark, rows, extra=("score", "predicted")), model).toPandas().set_index("doc_id")
    assert found["predicted"].to_dict() == {1: 1, 2: 0, 3: 0, 4: 0, 5: 0}
    assert found["score"].between(0, 1).all()
    assert score_toxicity(documents(spark, []), model).count() == 0


def test_a_labelled_id_with_very_many_rows(spark):
    """50,000 rows of one labelled id, half of them equal: the fit sees a few of them."""
    docs, labels = labelled(spark)
    many = spark.range(50_000).select(
        F.lit(3).cast("long").alias("doc_id"),
        F.when(F.col("id") % 2 == 0, F.lit("the same again")).otherwise(F.concat(F.lit("row "), "id")).alias("text"))
    model = fit_toxicity(docs.select("doc_id", "text").unionByName(many), labels)
    found = score_toxicity(documents(spark, [(1, text_of(5000, True)), (2, text_of(5001, False))]), model).toPandas()
    assert found["predicted"].tolist() == [1, 0]


def test_distances_are_window_lengths():
    """The three largest differences of the windows' compressed lengths, each compressed by itself."""
    plain, loaded = train_dictionaries([text_of(i, True) for i in range(40)], [text_of(i + 900, False) for i in range(80)])
    texts = [text_of(2000, True), text_of(2001, False), "", "one two"]

    def length(window, content):
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return len(zstandard.ZstdCompressor(
            level=6, dict_data=words, write_content_size=False, write_checksum=False, write_dict_id=False).compress(window))

    for text, row in zip(texts, distances(texts, plain, loaded), strict=True):
        cut = text.split()
        pieces = [f" {' '.join(cut[k:k + 12])} ".encode() for k in range(0, len(cut), 12)]
        gains = sorted((length(p, plain) - length(p, loaded) for p in pieces), reverse=True)[:3]
        assert row[:3].tolist() == (gains + [0, 0, 0])[:3] and abs(row[3] - np.log1p(len(pieces))) < 1e-12


def test_without_labels_or_difference(spark):
    docs, labels = labelled(spark, 40)
    nothing = fit_toxicity(docs, labels.limit(0))
    one = fit_toxicity(docs, labels.where("toxic = 0"))
    same = fit_model(["same text"] * 8, np.array([0, 1] * 4), (0.5, 0.5))
    for model in (nothing, one):
        assert score_toxicity(docs, model).agg(F.max("predicted")).first()[0] == 0
    assert same.scores(["x", None]).tolist() == [0.5, 0.5]


def test_held_out_quality(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op9_compression_toxicity"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").toPandas()
    bad, good = rows[rows["toxic"] == 1]["score"].to_numpy(), rows[rows["toxic"] == 0]["score"].to_numpy()
    assert (bad[:, None] > good[None, :]).mean() > 0.92
