import numpy as np

from wardline.llm import catalog, language_id, toxicity

SF = "/root/testdata/sf0.01"


def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    found = [r for r in catalog.op6_language_id(spark, SF).collect() if r.held_out]
    assert len(found) > 200
    assert sum(truth[r.doc_id] == r.lang_pred for r in found) > 0.98 * len(found)


def test_spans_of_mixed_text(spark, odd_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs)
    parts = {r.lang: r.text.split() for r in docs.where("n_chars > 1000").groupBy("lang").agg({"text": "max"}).toDF("lang", "text").collect()}
    first, second = sorted(parts)[:2]
    mixed = " ".join(parts[first][:80] + parts[second][:60])
    (row,) = language_id.identify(spark.createDataFrame([(1, mixed)], "doc_id int, text string"), model, with_spans=True).collect()
    assert row.lang_pred in (first, second) and [s.lang for s in row.spans] == [first, second]
    assert abs(row.spans[0].last - 80) < 12
    odd = {r.doc_id: r for r in language_id.identify(odd_docs, model).collect()}
    assert len(odd) == 7 and odd[1].lang_pred == odd[2].lang_pred == odd[3].lang_pred == "und" and odd[1].score == 0
    assert language_id.identify(no_docs, language_id.fit(no_docs)).count() == 0
    assert {r.lang_pred for r in language_id.identify(odd_docs, language_id.fit(no_docs)).collect()} == {"und"}


def test_viterbi_equals_all_paths():
    draw = np.random.default_rng(4)
    sizes = np.array([5, 0, 3, 7])
    scores = draw.normal(size=(15, 3)).astype(np.float32)
    labels = language_id.viterbi(scores, sizes, 0.7)

    def worth(path, s):
        return sum(s[i, p] for i, p in enumerate(path)) - 0.7 * sum(a != b for a, b in zip(path, path[1:]))

    begin = 0
    for n in sizes:
        s = scores[begin : begin + n]
        best = max((worth(p, s) for p in np.ndindex(*[3] * n)), default=0)
        assert abs(worth(labels[begin : begin + n], s) - best) < 1e-4
        begin += n


def test_scripts_narrow_the_candidates(spark):
    docs = spark.createDataFrame([("the cat sat on the mat", "en"), ("кот сидел на ковре", "ru"), ("le chat est assis", "fr")], "text string, lang string")
    model = language_id.fit(docs)
    ru = model.languages.index("ru")
    scores = language_id.score_words(model, ["ковер", "mat", "漢字"])
    assert np.isfinite(scores[0]).tolist() == [i == ru for i in range(3)] and not np.isfinite(scores[1, ru])
    assert np.isfinite(scores[2]).all()


def test_held_out_toxicity(spark):
    """The small table has few toxic rows; what is found must be right, and a larger table finds nearly all (README)."""
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in catalog.op1_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    toxic = [r for r in found if labels[r.doc_id]]
    hits = sum(r.predicted for r in toxic)
    assert hits > 0.7 * len(toxic)
    assert sum(r.predicted for r in found if not labels[r.doc_id]) < 0.02 * len(found)


def test_label_model_finds_accuracies_and_correlations():
    draw = np.random.default_rng(1)
    y = draw.random(200_000) < 0.2
    rates = [(0.5, 0.01), (0.4, 0.02), (0.3, 0.01), (0.6, 0.05)]
    votes = np.array([np.where(y, draw.random(len(y)) < t, draw.random(len(y)) < f) for t, f in rates], float)
    votes = np.vstack([votes, votes[3], draw.random(len(y)) < 0.1])
    model = toxicity.fit_label_model(len(y), votes.sum(1), votes @ votes.T, 0.2)
    assert np.allclose(model.on_toxic[:3], [0.5, 0.4, 0.3], atol=0.05)
    assert model.correlated[3, 4] and not model.correlated[0, 1] and abs(model.on_toxic[5] - model.on_clean[5]) < 0.02


def test_toxicity_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(odd_docs, labels)
    assert toxicity.score(odd_docs, model).count() == 8
    empty = toxicity.fit(no_docs, labels.limit(0))
    assert {round(r.score, 3) for r in toxicity.score(odd_docs, empty).collect()} == {0.018}
    assert toxicity.score(no_docs, model).count() == 0


def test_numerals_are_no_letters():
    assert language_id.words("½ ² Ⅷ ① x² 12") == ["x²"]
