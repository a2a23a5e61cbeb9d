import json
import random
import re

import duckdb
import pytest

from pricetide.llm import chat, licenses

from .frames import DOCS

SF001 = "/root/testdata/sf0.001"


def files(sp, rows):
    return sp.createDataFrame(rows, "path string, text string, licence string")


def test_headers_and_inheritance(sp):
    mit, gpl, apache = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0."
    rows = [("LICENSE", mit, "x"), ("a/b/COPYING", gpl, "x"), ("a/b/c/x.py", "code", "x"), ("a/y.py", "code\n# " + apache + "\nmore", "x"), ("a/z.py", None, "x"),
            ("q.py", "", "x"), (None, "nothing", "x"), ("a/b/c/n.py", "license unknown words entirely different story", "x"), ("d/LICENSE.txt", "no words of it", "x"), ("d/e", "text", "x")]
    got = {r["path"]: (r["licence"], r["origin"], r["from_path"]) for r in licenses.scan(files(sp, rows)).collect()}
    assert got == {"LICENSE": ("MIT", "header", None), "a/b/COPYING": ("GPL-3.0", "header", None), "a/b/c/x.py": ("GPL-3.0", "inherited", "a/b/COPYING"),
                   "a/y.py": ("Apache-2.0", "header", None), "a/z.py": ("MIT", "inherited", "LICENSE"), "q.py": ("MIT", "inherited", "LICENSE"),
                   "": ("MIT", "inherited", "LICENSE"), "a/b/c/n.py": ("GPL-3.0", "inherited", "a/b/COPYING"), "d/LICENSE.txt": ("MIT", "inherited", "LICENSE"),
                   "d/e": ("MIT", "inherited", "LICENSE")}


def test_scan_of_odd_tables(sp):
    assert licenses.scan(files(sp, [])).count() == 0
    twice = licenses.scan(files(sp, [("a/x", "Released under the MIT License.", "")] * 3)).collect()
    assert [(r["licence"], r["origin"]) for r in twice] == [("MIT", "header")] * 3
    docs = sp.createDataFrame([(None, None, None, None, None), (10, "Licensed under CC BY-NC 4.0.", "en", "s", 3), (11, "x", "en", "s", 1)], DOCS)
    got = {r["doc_id"]: (r["licence"], r["origin"]) for r in licenses.scan_documents(docs).collect()}
    assert got == {None: (None, "none"), 10: ("CC-BY-NC-4.0", "header"), 11: ("CC-BY-NC-4.0", "inherited")}


def test_every_template_names_its_licence(sp):
    rows = [(f"f{i}", t, "") for i, (_, t) in enumerate(licenses.TEMPLATES)]
    got = {r["path"]: r["licence"] for r in licenses.scan(files(sp, rows)).collect()}
    assert got == {f"f{i}": name for i, (name, _) in enumerate(licenses.TEMPLATES)}


def test_whole_licence_files_and_diluted_notices(sp):
    body = lambda name: (licenses.TEXTS / f"{name}.txt").read_text()
    names = sorted(f.stem for f in licenses.TEXTS.glob("*.txt"))
    rows = [(f"{name}/COPYING", body(name), "") for name in names] + [(f"{name}/src/deep/x.c", "int x;", "") for name in names]
    mit = body("MIT").replace("<year> <copyright holders>", "2019-2024 Some One and others") + "\nSome files are by others, see their own notes.\n"
    rows += [("mine/LICENSE", mit, ""), ("mine/y.c", "int y;", "")]
    others = ["the copyright of figures stays with their makers", "see the license folder for licences of fonts", "copyright notices are kept", "a licence for names is not given", "copyright 2011 someone else entirely"]
    rows += [("n/x.c", "\n".join(["code", *others[:3], "Released under the MIT License.", "more code", *others[3:]]), ""),
             ("n/run.c", "\n".join(["start", "Licensed under the Apache", "License, Version 2.0.", "other", *others]), ""),
             ("n/head.c", "This work is\nlicensed under the\nGNU General Public\nLicense, version 3.\n\ncode\n" + "\n".join(others), ""),
             ("n/none.c", "\n".join(others), "")]
    got = {r["path"]: (r["licence"], r["origin"]) for r in licenses.scan(files(sp, rows)).collect()}
    want = {f"{name}/COPYING": (name, "header") for name in names} | {f"{name}/src/deep/x.c": (name, "inherited") for name in names}
    assert got == want | {"mine/LICENSE": ("MIT", "header"), "mine/y.c": ("MIT", "inherited"), "n/x.c": ("MIT", "header"), "n/run.c": ("Apache-2.0", "header"),
                          "n/head.c": ("GPL-3.0", "header"), "n/none.c": (None, "none")}


CALLS = "conv_id long, call_id string, turn long, name string, arguments string, depends_on array<string>, json string"
RESULTS = "conv_id long, call_id string, turn long, content string"


def linked(sp, calls, results):
    return chat.link(sp.createDataFrame([c + ("x",) for c in calls], CALLS), sp.createDataFrame(results, RESULTS))


def test_linking_order_and_validation(sp):
    ok = '{"limit": 3, "query": "q\\n\\u00e9"}'
    calls = [(1, "c", 5, "search", ok, ["b", "a"]), (1, "a", 1, "search", ok, None), (1, "b", 9, "search", ok, ["a"]), (1, "b", 10, "search", ok, None),
             (1, "loop1", 11, "search", ok, ["loop2"]), (1, "loop2", 12, "search", ok, ["loop1"]), (1, "behind", 13, "search", ok, ["loop1"]),
             (2, "a", 1, "search", '{"limit": "x", "zz": 1}', None), (2, "n", 2, "search", "[1]", None), (2, "nn", 3, "search", None, None), (2, "bad", 4, "search", "{", None),
             (2, "t", 5, "nope", ok, None), (2, "m", 6, "search", ok, ["gone"]), (2, "o", 7, "lookup", '{"exact":true,"key":"k"}', None),
             (2, "p", 8, "calculate", '{"precision":1.5,"expression":"1"}', None), (None, None, None, None, None, None)]
    results = [(1, "a", 2, "ra"), (1, "a", 3, "later"), (1, "b", 3, "rb"), (1, "c", 6, "rc"), (2, "ghost", 1, "r"), (2, "m", 1, "r"), (2, "o", 9, None)]
    out = {(r["conv_id"], r["call_id"], r["turn"]): r for r in linked(sp, calls, results).collect()}
    assert len(out) == len(calls) + 1
    status = {k: r["status"] for k, r in out.items()}
    assert status == {(1, "a", 1): "ok", (1, "b", 9): "ok", (1, "c", 5): "ok", (1, "b", 10): "duplicate", (1, "loop1", 11): "cycle", (1, "loop2", 12): "cycle",
                      (1, "behind", 13): "cycle", (2, "a", 1): "invalid", (2, "n", 2): "invalid", (2, "nn", 3): "invalid", (2, "bad", 4): "invalid",
                      (2, "t", 5): "unknown_tool", (2, "m", 6): "missing_dependency", (2, "o", 7): "ok", (2, "p", 8): "no_result", (2, "ghost", 1): "orphan_result",
                      (None, None, None): "duplicate"}
    assert [out[k]["depth"] for k in ((1, "a", 1), (1, "b", 9), (1, "c", 5))] == [0, 1, 2]
    assert [out[k]["place"] for k in ((1, "a", 1), (1, "b", 9), (1, "c", 5))] == [1, 2, 3]
    assert out[(2, "a", 1)]["errors"] == "missing:query,type:limit,unknown:zz"
    assert out[(2, "n", 2)]["errors"] == "not_an_object"
    got = out[(1, "c", 5)]["json"]
    assert got == '{"arguments":{"limit":3,"query":"q\\né"},"depends_on":["a","b"],"id":"c","name":"search","result":"rc","status":"ok"}'
    assert all(json.loads(r["json"])["status"] == r["status"] for r in out.values())


def test_a_long_conversation_and_empty_tables(sp):
    calls = [(1, f"c{i}", i, "search", '{"query":"q","limit":1}', [f"c{i - 1}"] if 0 < i < 300 else None) for i in range(3000)]
    out = linked(sp, calls, [(1, f"c{i}", i, "r") for i in range(3000)]).orderBy("place").collect()
    assert [r["place"] for r in out] == list(range(1, 3001))
    assert [r["call_id"] for r in out] == [f"c{i}" for i in [0] + list(range(300, 3000)) + list(range(1, 300))]
    assert linked(sp, [], []).count() == 0
    turns = sp.createDataFrame([(None, None, None, None), (1, 0, "user", None), (1, 0, "user", None)], "conv_id long, turn long, role string, text string")
    assert chat.link_conversations(turns).count() == 2


def test_counts_before_of_long_chains(sp, monkeypatch):
    monkeypatch.setattr(chat, "DEPTHS", 4)
    rnd = random.Random(4)
    keys = sorted({(c, rnd.choice([*range(30), 1 << 30]), rnd.randrange(5)) for c in (0, 1, 2) for _ in range(120)})
    sizes = [(c or None, d, s, rnd.randint(1, 9)) for c, d, s in keys]        # 0: a conversation without a number
    out = chat.counts_before(sp.createDataFrame(sizes, "conv_id long, d long, segment long, n long"))
    assert {(r["c"], r["d2"], r["s2"]): r["n_before"] for r in out.collect()} == {
        (c, d, s): sum(n for c2, d2, s2, n in sizes if c2 == c and (d2, s2) < (d, s)) for c, d, s, _ in sizes}
    chain = linked(sp, [(1, f"c{i}", i, "search", "{}", [f"c{i - 1}"]) for i in range(9)], [])
    assert not re.search(r"windowspecdefinition\(conv_id#\d+L?, d#\d+L? ASC", chain._jdf.queryExecution().toString())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_depths_are_those_of_a_plain_search(sp, seed):
    rnd = random.Random(seed)
    needs = {f"c{i}": sorted({f"c{rnd.randrange(max(1, i))}" for _ in range(rnd.choice([0, 1, 1, 1, 2, 3]))} - {f"c{i}"}) for i in range(60)}
    needs["c7"], needs["c9"] = ["c9"], ["c7", "c1"]                  # a circle
    def depth(c, seen=()):
        if c in seen:
            return None
        under = [depth(d, (*seen, c)) for d in needs[c]]
        return None if None in under else 1 + max(under, default=-1)
    df = sp.createDataFrame([(1, c, d) for c, d in needs.items()], "conv_id long, call_id string, depends_on array<string>")
    assert {r["call_id"]: r["depth"] for r in chat.depths(df).collect()} == {c: depth(c) for c in needs}


@pytest.mark.parametrize("name,make,sql,table", [("op4", licenses.scan_documents, licenses.oracle, "documents"), ("op6", chat.link_conversations, chat.oracle, "conversations")])
def test_sql(sp, name, make, sql, table):
    df = make(sp.read.parquet(f"{SF001}/{table}.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF001}/{table}.parquet')")
    want = con.execute(sql())
    cols = sorted(c[0] for c in want.description)
    order = [c[0] for c in want.description]
    rows = sorted(str([r[order.index(c)] for c in cols]) for r in want.fetchall())
    assert sorted(df.columns) == cols
    assert sorted(str([r[c] for c in cols]) for r in df.collect()) == rows
