import math
import random
import re
from collections import Counter

import numpy as np

from pricetide.llm import lm

from .frames import awkward, docs


def held_out(i):
    import zlib
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1


def plain_base(rows):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", lower(t)) + [None]
    c = Counter(w for i, t in rows if not held_out(i) for w in split(t))
    n, v = sum(c.values()), len(c)
    out = []
    for i, t in rows:
        w = split(t)
        out.append((i if i is not None else -1, held_out(i), len(w), sum(x in c for x in w), n,
                    round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), 6)))
    return sorted(out)


def corpus(n, seed=1):
    rnd = random.Random(seed)
    kinds = [[f"{p}{i}" for i in range(120)] for p in ("ka", "mo", "zi")]
    rows = []
    for i in range(n):
        vocab = rnd.choice(kinds)
        rows.append((i, " ".join(vocab[min(119, int(rnd.expovariate(0.05)))] for _ in range(rnd.randint(5, 120)))))
    return rows


def test_base_scores_and_counts(sp, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 50)              # most words take the joined way
    rows = corpus(150) + awkward() + [(1000, "É A b  C\x0bd"), (1001, "unseen" * 5)]
    got = lm.score_documents(docs(sp, rows, extra=("row", "score", "word"))).collect()
    mine = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got)
    assert mine == plain_base(rows)


def test_beats_the_base_on_held_out_texts(sp):
    out = lm.score_documents(docs(sp, corpus(1200))).where("held_out").collect()
    assert sum(r["score"] for r in out) > 0.93 * sum(r["base_score"] for r in out)


def test_probabilities_are_normalised():
    rows = corpus(80)
    count = Counter(w for _, t in rows for w in lm.words(t))
    frequent = sorted(count.items(), key=lambda x: (-x[1], x[0]))[:200]
    tokens, kinds = np.zeros(lm.CLASSES), np.zeros(lm.CLASSES)
    for w, c in frequent[lm.SHORT:]:
        tokens[lm.word_class(w)] += c
        kinds[lm.word_class(w)] += 1
    vocab = lm.Vocabulary(frequent, 80, sum(count.values()) + 80, len(count) + 1, tokens, kinds)
    trainer = lm.Trainer(lm.Model.fresh(vocab), vocab.noise, 1)
    trainer.texts(vocab, [vocab.codes(lm.words(t)) for _, t in rows])
    ctx = np.random.RandomState(0).randint(0, vocab.start + 1, (7, lm.CONTEXT))
    for k in range(7):
        each = trainer.model.log10_probabilities(np.repeat(ctx[k:k + 1], len(vocab.noise), axis=0), np.arange(len(vocab.noise)))
        assert abs((10 ** each).sum() - 1) < 1e-5


def plain_score(text, count, vocab, model):
    """log10 of the text's probability, token by token, from the model's parameters."""
    r, c, q, b = (p.astype(np.float64) for p in model.parts)
    rank = {w: k for k, w in enumerate(sorted((w for w in count if w != lm.END), key=lambda w: (-count[w], w))[:lm.FREQUENT])}
    rest = [w for w in count if w != lm.END and rank.get(w, lm.SHORT) >= lm.SHORT]
    size = Counter()
    kinds = Counter()
    for w in rest:
        size[lm.word_class(w)] += count[w]
        kinds[lm.word_class(w)] += 1
    before, total = [vocab.start] * lm.CONTEXT, 0.0
    for w in [*lm.words(text), None]:
        hat = sum(r[before[k - lm.CONTEXT]] * c[k] for k in range(lm.CONTEXT))
        scores = q @ hat + b
        cls = None if w is None else lm.word_class(w)
        own = w is not None and rank.get(w, lm.SHORT) < lm.SHORT
        goal = vocab.n_short if w is None else rank[w] if own else vocab.n_short + 1 + cls
        total += (scores[goal] - np.log(np.exp(scores - scores.max()).sum()) - scores.max()) / math.log(10)
        if w is not None and not own:
            total += math.log10((count.get(w, 0) + 0.5) / (size[cls] + 0.5 * (kinds[cls] + 1)))
        before.append(rank[w] if w in rank and rank[w] < vocab.n_input else vocab.n_input + (cls or 0))
    return total


def test_scores_are_those_of_a_plain_recomputation(sp, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 150)
    monkeypatch.setattr(lm, "SHORT", 40)
    monkeypatch.setattr(lm, "INPUT", 90)
    seen = {}
    train = lm.train

    def keep(docs, coded, vocab):
        seen["vocab"], seen["model"] = vocab, train(docs, coded, vocab)
        return seen["model"]
    monkeypatch.setattr(lm, "train", keep)
    rows = [(i, t) for i, t in corpus(120) + awkward() if t is None or len(t) < 10_000] + [(1000, "É A b  C\x0bd unseen")]
    got = lm.score_documents(docs(sp, rows, extra=("codes", "rare"))).collect()
    count = Counter(w for i, t in rows if not held_out(i) for w in [*lm.words(t), lm.END])
    texts = {}
    for i, t in rows:
        texts.setdefault((i, len(lm.words(t)) + 1), []).append(plain_score(t, count, seen["vocab"], seen["model"]))
    assert len(got) == len(rows)
    for r in got:
        assert min(abs(r["score"] - x) for x in texts[(r["doc_id"], r["n_tokens"])]) < 1e-3 * r["n_tokens"]


def test_contexts_stay_within_a_text():
    got = lm.contexts([np.array([5, 6]), np.array([], np.int64), np.array([7])], 9)
    assert got.tolist() == [[9, 9, 9, 9], [9, 9, 9, 5], [9, 9, 5, 6], [9, 9, 9, 9], [9, 9, 9, 9], [9, 9, 9, 7]]


def test_empty_and_untrained(sp):
    assert lm.score_documents(docs(sp, [])).count() == 0
    only = [(i, "a b") for i in range(40) if held_out(i)][:3]
    out = lm.score_documents(docs(sp, only)).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in out} == {(0, 0, 0.0)}


def test_a_step_draws_64_noise_samples():
    vocab = lm.Vocabulary([(b"a", 5), (b"b", 3)], 2, 10, 3, np.zeros(lm.CLASSES), np.zeros(lm.CLASSES))
    trainer = lm.Trainer(lm.Model.fresh(vocab), vocab.noise, 1)
    drawn = []

    class Draws:
        def random_sample(self, n):
            drawn.append(n)
            return np.linspace(0, 0.99, n)

    trainer.rng = Draws()
    trainer.step(np.full((6, lm.CONTEXT), vocab.start), np.array([0, 1, 0, 0, 1, vocab.end]))
    assert drawn == [64]
