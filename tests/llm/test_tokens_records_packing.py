import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pricetide.llm import packing, records, tokens
from pricetide.llm.common import shared_folder

from .frames import awkward, docs


def brute(text):
    tok = tokens.load_tokenizer(tokens.tokenizer_path())
    return tok.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_those_of_the_whole_text():
    rnd = random.Random(3)
    odd = ["a  b", "a \n b", "a\n b", "it's  don't 're", "<|endoftext|> a", "a\t b \tc", "日本 語 x", "a\u0085 b",
           "“a” b’s", "\n", "a..b!!c", ".a", "1.5,a,", "x　 y"]
    odd += ["".join(rnd.choice("ab  \n\té '1.日!,? ") for _ in range(40)) for _ in range(800)]
    ids, off = tokens.encode_texts(pa.array(odd + [None]), tokens.tokenizer_path())
    for i, t in enumerate(odd + [None]):
        assert ids[off[i]:off[i + 1]].tolist() == brute(t)


def test_known_words_stay_bounded():
    known = tokens._KnownWords(tokens.tokenizer_path())
    known.MOST = 3
    for batch in (["a", " bb"], [" cc", " dd"], [" cc", "a", " dd"]):
        ids, first, size = known.look_up(pa.array(batch, pa.large_string()))
        for w, f, s in zip(batch, first, size):
            assert ids[f:f + s].tolist() == brute(w)[:-1]
    assert len(known.words) <= 3


def test_known_words_keep_the_frequent_ones():
    known = tokens._KnownWords(tokens.tokenizer_path())
    known.MOST = 40
    look = lambda ws: known.look_up(pa.array(ws, pa.large_string()))
    for turn in range(12):
        words = [" often", " always"] + [f" rare{turn}x{i}" for i in range(15)]
        ids, first, size = look(words)
        for w, f, s in zip(words, first, size):
            assert ids[f:f + s].tolist() == brute(w)[:-1]
    assert len(known.words) <= 40 and len(known.ids) < 40 * 8
    before = len(known.words)
    look([" often", " always"])
    assert len(known.words) == before                        # both were still known


def test_a_cut_file_is_noticed(sp):
    import glob
    folder = shared_folder(sp, "records-cut")
    index = records.write_records(docs(sp, [(i, f"text {i}") for i in range(20)]).repartition(1), folder).collect()
    last = max((r for r in index), key=lambda r: (r["file"], r["position"]))
    path = glob.glob(f"{folder.removeprefix('file:')}/data/{last['file']}")[0]
    with open(path, "r+b") as f:
        f.truncate(last["position"])                         # at a frame's boundary
    with pytest.raises(Exception, match="does not hold the records of its index"):
        records.read_records(sp, folder).collect()


def test_plain_paths_are_those_of_spark(sp):
    assert records._qualified(sp, "/tmp/some folder/x").startswith("file:///tmp/some")
    assert records._qualified(sp, "file:/tmp/x") == "file:///tmp/x"


def test_group_size_is_bounded(sp):
    with pytest.raises(ValueError, match="group_pieces"):
        packing.pack_documents(docs(sp, [(1, "a")]), group_pieces=35_000)


def test_records_round_trip(sp):
    rows = awkward()
    folder = shared_folder(sp, "records-test")
    index = records.write_records(docs(sp, rows, extra=("start", "n_tokens")), folder, file_bytes=50_000)
    got = records.read_records(sp, folder).collect()
    assert len(got) == len(rows)
    want = sorted(((i is not None, i or 0, brute(t)) for i, t in rows), key=lambda r: r[:2])
    got.sort(key=lambda r: r["start"])
    assert [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got] == [w[:2] for w in want]
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    by_id = lambda rs: sorted(rs)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    assert by_id((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got) == by_id((w[1], len(w[2]), crc(w[2])) for w in want)
    for row in index.collect()[:4]:                       # shuffled reads by the index
        d, ids = records.read_at(folder, row["file"], row["position"])
        assert d == row["doc_id"] and len(ids) == row["n_tokens"]


def test_damage_is_found():
    import io
    data = bytearray(records.frame(7, np.array([1, 2, 3]), 2))
    assert records.read_frame(io.BytesIO(bytes(data)))[1].tolist() == [1, 2, 3]
    for place in (0, 9, 14, len(data) - 1):
        bad = bytearray(data)
        bad[place] ^= 1
        with pytest.raises(ValueError):
            records.read_frame(io.BytesIO(bytes(bad)))


def test_empty_tables(sp):
    empty = docs(sp, [])
    assert records.records_round_trip(empty).count() == 0
    assert packing.pack_documents(empty).count() == 0


def plain_sum_of_squares(lengths, capacity):
    gaps, out = [], []
    for s in lengths:
        def total(change):
            n = {}
            for g in change:
                if g:
                    n[g] = n.get(g, 0) + 1
            return sum(v * v for v in n.values())
        options = []
        for b, g in enumerate(gaps):
            if g >= s:
                options.append((total(gaps[:b] + [g - s] + gaps[b + 1:]), 0, g, b))
        options.append((total(gaps + [capacity - s]), 1, capacity, len(gaps)))
        best = min(options)[:3]
        out.append((best[0], best[2]))
        b = next(o[3] for o in options if o[:3] == best)
        if b == len(gaps):
            gaps.append(capacity - s)
        else:
            gaps[b] -= s
    return len(gaps), sorted(gaps)


@pytest.mark.parametrize("seed", range(6))
def test_placement_follows_the_rule(seed):
    rnd = np.random.RandomState(seed)
    lengths = rnd.randint(1, 25, 60)
    seq, offset = packing.sum_of_squares(lengths, 24)
    fill = np.bincount(seq, lengths)
    assert fill.max() <= 24
    assert (len(fill), sorted((24 - fill).tolist())) == plain_sum_of_squares(lengths.tolist(), 24)


def check_packing(rows, out, capacity=2048):
    by_seq, by_doc = {}, {}
    for r in out:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
        assert at <= capacity
    want = sorted((d if d is not None else -1, k, s, n, zlib.crc32(np.array(brute(t)[s:s + n], "<u4").tobytes()))
                  for d, t in rows for k, (s, n) in enumerate(packing.cut_points(len(brute(t)), capacity)))
    assert want == sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out)
    return len(by_seq)


def test_packing_keeps_every_id_and_gets_few_sequences(sp):
    rnd = random.Random(5)
    rows = awkward() + [(100 + i, " ".join(rnd.choice(["the", "of", "house"]) for _ in range(rnd.randint(1, 1900)))) for i in range(300)]
    out = packing.pack_documents(docs(sp, rows, extra=("offset", "length"))).collect()
    total = sum(len(brute(t)) for _, t in rows)
    assert check_packing(rows, out) <= 1.02 * total / 2048 + 1
    # groups of 40 pieces, two a sequence, leave more open than groups of thousands do
    small_groups = packing.pack_documents(docs(sp, rows), group_pieces=40).collect()
    assert check_packing(rows, small_groups) <= 1.10 * total / 2048
