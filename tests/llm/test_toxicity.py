import math
import random

import numpy as np

from pricetide.llm import toxicity

from .frames import awkward, docs

BAD = ["zorgfel", "muckrat", "blithex", "quonker"]


def corpus(n, seed):
    rnd = random.Random(seed)
    vocab = ["".join(rnd.choice(["an", "the", "is", "on", "re", "ti", "er", "ou", "st"]) for _ in range(rnd.randint(1, 4))) for _ in range(3000)]
    rows, marks = [], []
    for i in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(30, 200))]
        bad = rnd.random() < 0.3
        if bad:
            for _ in range(max(2, len(w) // 25)):
                w.insert(rnd.randrange(len(w)), rnd.choice(BAD))
        rows.append((i, " ".join(w)))
        marks.append(int(bad))
    return rows, marks


def test_held_out_accuracy(sp):
    rows, marks = corpus(1500, 1)
    labels = sp.createDataFrame([(i, 1, m) for (i, _), m in zip(rows, marks)], "doc_id long, quality int, toxic int")
    df = docs(sp, rows, extra=("score", "held_out"))
    model = toxicity.train(df, labels)
    got = {r["doc_id"]: r for r in toxicity.score_documents(df, model).collect()}
    held = [i for i, _ in rows if got[i]["held_out"]]
    assert 200 < len(held) < 400
    right = np.mean([got[i]["predicted"] == marks[i] for i in held])
    assert right >= 0.95
    kept = {r["doc_id"] for r in toxicity.drop_toxic(df, model).collect()}
    assert kept == {i for i, _ in rows if got[i]["predicted"] == 0}
    assert toxicity.drop_toxic(df, model).columns == df.columns


def test_labels_of_held_out_rows_are_not_read(sp):
    import zlib
    rows, marks = corpus(300, 2)
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    frame = lambda f: sp.createDataFrame([(i, 1, f(i, m)) for (i, _), m in zip(rows, marks)], "doc_id long, quality int, toxic int")
    a = toxicity.train(docs(sp, rows), frame(lambda i, m: m))
    b = toxicity.train(docs(sp, rows), frame(lambda i, m: 1 - m if i in held else m))
    assert a.toxic == b.toxic and np.array_equal(a.weights, b.weights)


def test_awkward_rows_and_missing_labels(sp):
    rows, marks = corpus(200, 3)
    labels = sp.createDataFrame([(i, 1, m) for (i, _), m in zip(rows, marks)] + [(None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(sp, rows), labels)
    out = toxicity.score_documents(docs(sp, awkward()), model).collect()
    assert len(out) == len(awkward()) and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in out)
    none = toxicity.train(docs(sp, rows), labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score_documents(docs(sp, awkward()), none).collect()} == {0.0}
    assert toxicity.train(docs(sp, []), labels).weights.tolist() == [0.5]
    assert toxicity.score_documents(docs(sp, []), model).count() == 0


def test_windows_cover_the_whole_text():
    text = "a bb " + "x" * 100 + " c"
    joined = b"".join(toxicity.windows(text)).replace(b" ", b"")
    assert joined == text.replace(" ", "").encode()
    assert toxicity.windows(None) == [] and toxicity.windows(" \n") == []


def plain_score(model, text):
    """The score of a text window by window, from the model's dictionaries and curve."""
    import zstandard as zs
    params = zs.ZstdCompressionParameters(
        strategy=zs.STRATEGY_LAZY2, min_match=4, window_log=20, hash_log=17, chain_log=17, search_log=6,
        target_length=32, write_content_size=False, write_checksum=False, write_dict_id=False)

    def size(content, window):
        d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
        return len(zs.ZstdCompressor(compression_params=params, dict_data=d).compress(window + b"\n" * 40))
    words = []
    for w in (text or "").lower().split():
        words += [w[i:i + 32] for i in range(0, len(w), 32)]
    evidence, strong, n = 0.0, 0, 0
    for i in range(0, len(words), 2):
        window = (" " + " ".join(words[i:i + 2]) + " ").encode()
        saved = size(model.ordinary, window) - size(model.ordinary + model.toxic, window)
        ratio = model.ratio[min(max(saved, toxicity.LOW), toxicity.HIGH) - toxicity.LOW]
        evidence += ratio if ratio >= 1.0 else 0.0
        strong += ratio >= 3.0
        n += 1
    x = [math.log1p(evidence), math.log1p(n), strong / math.sqrt(n + 1), min(strong, 3), 1.0]
    return 1 / (1 + math.exp(-sum(a * b for a, b in zip(x, model.weights))))


def test_scores_are_those_of_a_plain_recomputation(sp):
    rows, marks = corpus(200, 4)
    labels = sp.createDataFrame([(i, 1, m) for (i, _), m in zip(rows, marks)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs(sp, rows), labels)
    some = rows[:12] + [(9001, ""), (9002, None), (9003, "x" * 100 + " y")]
    got = {r["doc_id"]: r["score"] for r in toxicity.score_documents(docs(sp, some), model).collect()}
    for i, t in some:
        assert abs(got[i] - plain_score(model, t)) < 1e-9
