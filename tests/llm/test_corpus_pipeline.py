"""corpus_pipeline.run against a chain of plain versions of its stages."""

import random
import uuid

import corpus_pipeline
from pricetide.llm import packing, toxicity
from pricetide.llm.common import table
from pricetide.session import checkpoint_dir

from .frames import docs
from .test_decontamination import plain_leaks
from .test_neardup import plain_classes
from .test_toxicity import corpus
from .test_tokens_records_packing import brute


def tables(sp, rows, labels, items):
    folder = f"{checkpoint_dir(sp)}/pipeline-test-{uuid.uuid4().hex}"
    docs(sp, rows).write.parquet(f"{folder}/documents.parquet")
    sp.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    sp.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_run_is_the_chain_of_its_stages(sp):
    rnd = random.Random(12)
    rows, marks = corpus(240, 5)
    labels = [(i, 1, m) for (i, _), m in zip(rows, marks)]
    clean = [t.split() for (_, t), m in zip(rows, marks) if not m]
    passage = [f"{w}{k}" for k, w in enumerate(clean[0][:25])]
    for k in range(12):                                        # near copies, and texts with the passage
        copy = list(clean[k + 1])
        copy[rnd.randrange(len(copy))] = "changed"
        rows.append((1000 + k, " ".join(copy)))
        rows.append((2000 + k, " ".join(clean[k + 20][:30] + passage + clean[k + 21][:30])))
    rows += [rows[3], rows[3], (3000, None), (3001, ""), (None, "no id here")]
    items = [(1, " ".join(passage)), (2, None)]
    folder = tables(sp, rows, labels, items)

    model = toxicity.train(table(sp, folder, "documents"), table(sp, folder, "labels"))
    score = model.scorer()
    kept = [(d, t) for d, t in rows if score(t) < 0.5]
    assert 20 < len(rows) - len(kept) < 120
    least = {c for _, c, _, _ in plain_classes(sp, kept)}
    seen, one = set(), []
    for d, t in kept:
        if d in least and d not in seen:
            seen.add(d)
            one.append((d, t))
    leaking = {d for d, _ in plain_leaks(one, [(i, t) for i, t in items if t])}
    left = [(d, t) for d, t in one if d not in leaking]
    assert len(leaking) >= 10 and len(one) < len(kept)

    got = corpus_pipeline.run(sp, folder).collect()
    assert {r["doc_id"] for r in got} == {d for d, _ in left}
    tokens = {}
    for r in got:
        tokens[r["doc_id"]] = tokens.get(r["doc_id"], 0) + r["length"]
    assert tokens == {d: len(brute(t)) for d, t in left}
    ends = {}
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= packing.CAPACITY


def test_empty_tables(sp):
    assert corpus_pipeline.run(sp, tables(sp, [], [], [])).count() == 0
