from edge import empty_docs, edge_docs
from pyspark.sql import functions as F

from millrace.llm import toxicity as X
from millrace.llm.queries import load

SF = "/root/testdata/sf0.01"


def quality(rows):
    """Share of right pairs of a toxic and another text; precision and recall at the threshold."""
    yes, no = ([r["score"] for r in rows if r["toxic"] == k] for k in (1, 0))
    pairs = sum((a > b) + 0.5 * (a == b) for a in yes for b in no) / (len(yes) * len(no))
    hit = sum(s >= X.THRESHOLD for s in yes)
    return pairs, hit / max(1, hit + sum(s >= X.THRESHOLD for s in no)), hit / len(yes)


def test_held_out_texts(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    rows = X.scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
    pairs, precision, recall = quality(rows)
    assert pairs > 0.95 and precision > 0.95 and recall > 0.85


def test_only_allowed_inputs(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    first = {r["doc_id"]: tuple(r) for r in X.scores(docs, labels).collect()}
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    assert {r["doc_id"]: tuple(r) for r in X.scores(other, turned).collect()} == first


def test_edges(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (4, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0), (99, 1, 0)], "doc_id long, toxic int, text int")
    for known in (labels, labels.limit(0)):
        rows = X.scores(docs, known).collect()
        assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
        assert X.reject(docs, known).columns == docs.columns
    assert {r["score"] for r in rows} == {0.5}
    assert X.scores(empty_docs(spark), labels).count() == 0


def test_voters_that_say_the_same_share_their_say():
    import numpy as np

    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.3
    vote = lambda right: np.where(rng.random(4000) < right, truth, ~truth)
    one, two = vote(0.8), vote(0.8)
    votes = np.stack([one, one, one, two], axis=1).astype(float)
    gold = np.stack([np.append(((votes * w[:, None]).T @ votes).ravel(), w.sum()) for w in (~truth * 1.0, truth * 1.0)])
    model = X._next_model(np.zeros_like(gold), gold)
    assert model.worth[0] < 0.4 < 0.9 < model.worth[3] and abs(model.share - 0.3) < 0.05


def test_scaled_scores_are_as_likely_as_they_say():
    import numpy as np

    rng = np.random.default_rng(1)
    logit = rng.normal(0, 3, 20_000)
    toxic = (rng.random(20_000) < X._logistic(logit)).astype(float)
    slope, shift = X._scaling(logit / 4 - 2, toxic)  # the same order, but too cautious
    assert abs(slope - 4) < 0.3 and abs(shift - 8) < 0.6
    # One class tells nothing, and an order the labels contradict is not turned round.
    assert X._scaling(logit, np.ones(20_000)) == (1.0, 0.0) and X._scaling(-logit, toxic) == (1.0, 0.0)


def kinds_and_keys(texts):
    import numpy as np
    import pyarrow as pa
    from millrace.llm.words import split_words

    words = split_words(pa.array(texts))
    parts = X._terms(words, np.arange(len(words.starts))), X._grams(words)
    found = {k: set() for k in range(len(texts))}
    for word, kind, key in parts:
        for text, term in zip(np.searchsorted(words.first, word, side="right") - 1, zip(kind.tolist(), key.tolist())):
            found[int(text)].add(term)
    return found


def test_words_are_known_whole_and_characters_from_every_position():
    found = kinds_and_keys(["internationalise", "internationalist", "x" * 5000 + "a", "x" * 5000 + "b", "これはばかです", "ばか", "かばを見た",
                            "а«дурак»", "дурак", None, "a 🤬b", "🤬"])
    long = [{t for t in found[k] if t[0] == X.LONG} for k in range(4)]
    assert all(len(t) == 1 for t in long) and long[0] != long[1] and long[2] != long[3]
    grams = {k: {t for t in found[k] if t[0] > X.GRAM} for k in found}
    assert len(grams[5]) == 1 and grams[5] <= grams[4] and not grams[5] & grams[6]
    assert len(grams[8]) == 2 and grams[8] <= grams[7]
    assert grams[10] == grams[11] != set() and not found[9]
    # Texts follow one another without a blank: nothing is read across.
    assert not any(t[0] > X.GRAM for t in kinds_and_keys(["ば", "か"])[0])


def labelled(spark, telling, plain, rows=1200):
    """Every third text toxic by one telling word only; all labelled, so a third is held out."""
    import random

    rng = random.Random(3)
    own = lambda: " ".join(f"w{rng.randint(0, 400)}" for _ in range(30))
    data = [(k, f"{own()} {telling if k % 3 == 0 else plain} {own()}", int(k % 3 == 0)) for k in range(rows)]
    docs = spark.createDataFrame([(k, t) for k, t, _ in data], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, y) for k, _, y in data], "doc_id long, toxic int")


def test_telling_ends_of_long_words_and_words_without_blanks(spark):
    for telling, plain in (("internationalise", "internationalist"), ("今日はばかですね", "今日はよいですね")):
        docs, labels = labelled(spark, telling, plain)
        rows = X.scores(docs, labels).filter("held_out").join(labels, "doc_id").collect()
        pairs, precision, recall = quality(rows)
        assert pairs > 0.99 and precision > 0.99 and recall > 0.95


def test_terms_are_counted_in_all_labelled_rows(spark):
    docs, labels = labelled(spark, "badword", "goodword", 1500)
    rare = F.when(F.col("doc_id") % 51 == 0, F.concat("text", F.lit(" seldomword"))).otherwise(F.col("text"))
    model = X.fit(docs.withColumn("text", rare), labels, fit_rows=100)
    import pyarrow as pa

    low, high = model.terms.hits(X.split_words(pa.array(["none", "seldomword"])))
    assert 1 in low  # some 20 of 1,000 labelled rows hold it, about two of the sample
