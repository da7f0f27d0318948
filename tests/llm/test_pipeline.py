import hashlib
import random

import brute
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from wardline.llm import decontaminate, quality


def test_stages_follow_each_other_and_equal_brute_force(spark, fresh_dir):
    draw = random.Random(3)
    prose = lambda k: " ".join(f"w{draw.randrange(10**5)}" for _ in range(k))
    item = prose(30)
    docs = [(i, prose(40)) for i in range(30)]
    # An edit of the first word leaves a near copy; one in the middle changes five shingles of 36 and leaves another document.
    middle = docs[5][1].split(" ")
    middle[20] = "edited"
    docs += [(100, docs[3][1]), (101, "edited " + docs[4][1].split(" ", 1)[1]), (102, "too short"), (103, "a b c d e f " * 9), (106, " ".join(middle))]
    docs += [(104, prose(20) + " " + item.upper() + " " + prose(10)), (105, prose(20) + " password=hunter2hunter2 " + prose(10))]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    frame.write.parquet(f"{fresh_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{fresh_dir}/benchmark.parquet")
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, fresh_dir).collect()}

    left = [(i, t) for i, t in docs if i not in (102, 103)]
    first = {d for d, _, c in brute.classes(left) if d == c}
    left = [(i, t) for i, t in left if i in first]
    left = [(i, t) for i, t in left if brute.closest_passage(decontaminate.words(item), decontaminate.words(t)) > 6]
    left = [(i, t.replace("password=hunter2hunter2", "<assign>")) for i, t in left]
    assert set(out) == {i for i, _ in left} and not {100, 101, 104} & set(out) and {5, 106} <= set(out)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for i, text in left:
        ids = np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        assert out[i].ids == ids and out[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_one_of_many_near_copies_stays(spark, fresh_dir):
    """Near copies with edits in few lines, in groups well above and just above the line limit."""
    draw = random.Random(5)
    prose = lambda k: " ".join(f"w{draw.randrange(10**5)}" for _ in range(k))
    notice = "all rights reserved by the owner of this page"
    docs = [(i, prose(30) + "\n" + notice) for i in range(130)]
    groups = []
    for first, n, edits in ((1000, 150, 1), (2000, 150, 2), (3000, 106, 1)):
        base = [prose(10) for _ in range(40)]
        groups.append(first)
        for i in range(n):
            lines = list(base)
            for at in draw.sample(range(40), edits):
                lines[at] = lines[at].rsplit(" ", 1)[0] + f" e{i}"
            docs.append((first + i, "\n".join([*lines, notice])))
    # Nothing but the notice: taken out, so nothing is left.
    docs += [(5000, notice + "\n" + notice.upper() + " ")]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    cleaned = {r.doc_id: r for r in quality.clean(frame).collect()}
    texts = dict(docs)
    assert set(cleaned) == set(texts) - {5000}
    assert all(r.text == texts[i].rsplit("\n", 1)[0] and r.n_chars == len(r.text) for i, r in cleaned.items())
    frame.write.parquet(f"{fresh_dir}/documents.parquet")
    spark.createDataFrame([(1, prose(30))], "item_id bigint, text string").write.parquet(f"{fresh_dir}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, fresh_dir).collect()} == {*range(130), *groups}


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        columns = docs.columns
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, sf)
            assert docs.columns == columns
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf).count() == docs.count()


def test_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
    assert len(corpus_pipeline.STAGES) == 5
