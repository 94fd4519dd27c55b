"""Hard negatives, spelling variants and chat formatting against brute force, and on rows of every odd kind."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tickweave.llm import chat, hard_negatives, spelling

SF = "/root/testdata/sf0.001"


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- hard negatives -------------------------------------------------------------

def mined(rows, is_anchor, low=80, n_pos=5, n_neg=5):
    """rows: {id: (vector, label)}."""
    out = []
    for a in filter(is_anchor, rows):
        va, la = rows[a]
        score = {i: max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(va, v)))) for i, (v, _) in rows.items() if i != a and len(v) == len(va)}
        best = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in best if rows[i][1] == la][:n_pos]:
            fits = [i for i in best if rows[i][1] != la and low * score[p] <= 100 * score[i] <= 100 * score[p]][:n_neg]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fits)]
    return sorted(out, key=repr)


def vectors(spark, rows):
    return spark.createDataFrame([(i, list(v), l) for i, (v, l) in rows.items()], "vec_id long, vec array<bigint>, label int")


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("seed,width,spread", [(1, 3, 4), (2, 8, 30), (3, 2, 2)])
def test_hard_negatives_against_brute_force(spark, monkeypatch, seed, width, spread):
    monkeypatch.setattr(hard_negatives, "SLICE_ROWS", 70)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BYTES", 8 * 8 * (width + 2))
    rnd = random.Random(seed)
    hot = [rnd.randint(-spread, spread) for _ in range(width)]
    # a third of all rows hold one vector; small ranges give many ties
    rows = {i: (hot if rnd.random() < 0.33 else [rnd.randint(-spread, spread) for _ in range(width)], rnd.randint(0, 3)) for i in rnd.sample(range(-500, 5000), 400)}
    got = hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0)
    assert got.columns == COLUMNS
    assert tuples(got) == mined(rows, lambda i: i % 10 == 0)


def test_hard_negatives_query(spark):
    t = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    rows = {r["vec_id"]: ([math.floor(256 * x) for x in r["embedding"]], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in t}
    assert tuples(E.queries()["op11_hard_negatives"](spark, SF).select(*COLUMNS)) == mined(rows, lambda i: i % 100 == 0)


def test_hard_negatives_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    given = [(0, [1.0, 2.0], 1, "x"), (0, [1.0, 2.0], 1, "x"), (0, [9.0, 9.0], 1, "x"), (1, [2.0, 1.0], 1, None), (2, [1.0, 1.0], 2, "x"), (3, [1.0, nan], 2, "x"),
             (4, [1.0, None], 2, "x"), (5, None, 2, "x"), (6, [1.0, 2.0], None, "x"), (7, [inf, 1.0], 2, "x"), (None, [1.0, 2.0], 2, "x"), (8, [], 2, "x"),
             (9, [1.0, 2.0, 3.0], 2, "x"), (10, [1e30, 1e30], 2, "x"), (11, [1.5, 1.5], 3, "x"), (100, [], 1, "x"), (200, [0.0, 0.0], 1, "x")]
    df = spark.createDataFrame(given, "vec_id long, embedding array<double>, label int, slot string").withColumns({"score": F.lit(1), "found_id": F.lit("x")})
    rows = hard_negatives.usable(df, "vec_id", "embedding", "label").withColumn("vec", hard_negatives.scaled(F.col("vec"), 256))
    assert {r["vec_id"] for r in rows.collect()} == {0, 1, 2, 8, 9, 10, 11, 100, 200}
    got = hard_negatives.mine(rows.withColumn("rank", F.lit(0)), F.col("vec_id") % 100 == 0)
    expected = mined({r["vec_id"]: (r["vec"], r["label"]) for r in rows.collect()}, lambda i: i % 100 == 0)
    assert expected and tuples(got) == expected
    assert hard_negatives.mine(rows.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_products_are_exact_at_every_size():
    rnd = np.random.Generator(np.random.PCG64(5))
    for scale in (1 << 8, 1 << 28, 1 << 40, 1 << 62):
        a, b = (rnd.integers(-scale, scale, (4, 6)) for _ in range(2))
        exact = [[max(-2**63, min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(v, w)))) for w in b] for v in a]
        assert hard_negatives.products(a, b).tolist() == exact


# --- spelling variants ----------------------------------------------------------

def counted(docs, drop=199):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def variants(words):
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    best = {w: min(vs, key=lambda v: (-words[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if words[v] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=repr)


def test_spelling_query(spark):
    t = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pydict()
    words = counted(zip(t["doc_id"], t["text"]))
    got = E.queries()["op12_spelling"](spark, SF)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert len(words) > 500 and tuples(got) == variants(words)


@pytest.mark.parametrize("bounds", [(20_000, 32), (6, 32), (40, 3)])
def test_pairs_of_dense_words(spark, monkeypatch, bounds):
    # few letters: hot halves, runs of one letter, pairs that several edits explain
    monkeypatch.setattr(spelling, "STATE_WORDS", bounds[0])
    monkeypatch.setattr(spelling, "REST", bounds[1])
    monkeypatch.setattr(spelling, "BUCKET_WORDS", 200)
    rnd = random.Random(9)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9))) for _ in range(500)} | {"a" * k for k in range(1, 14)}
                   | {"prefix" + "".join(rnd.choice("xyz") for _ in range(5)) for _ in range(150)} | {"q" * 80 + x + "r" * 70 for x in ("", "s", "t", "st")})
    frame = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "id long, word string")
    got = {r["id"]: (r["n_near"], r["best"]) for r in spelling.near_words(frame).collect()}
    expected = {}
    for i, v in enumerate(words):
        near = [j for j, w in enumerate(words) if one_edit(v, w)]
        if near:
            expected[i] = (len(near), min(near))
    assert got == expected


def test_spelling_on_odd_rows(spark):
    texts = [(1, "Colour colour COLOUR colour colour " * 6), (2, "color's colouur colouur colouur colouur colouur"), (3, None), (4, ""), (None, "wordone wordone wordone"),
             (None, "wordone wordone"), (5, "ÉCLAIRS Éclairs éclairs " * 5), (6, "x" * 30_000), (6, "x" * 30_000), (7, " ".join(["y" * 3000, "y" * 3001] * 5)), (8, "naïveté×÷ " * 5)]
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in texts], "doc_id long, text string, word string, n int").repartition(3)
    assert tuples(spelling.group_variants(df)) == variants(counted(texts))
    assert spelling.group_variants(df.limit(0)).collect() == []


def test_roots_follow_long_chains(spark):
    # a chain of words, each five times as frequent as the one before
    words = ["abcdef" + "g" * k for k in range(6)]
    text = " ".join(w for k, w in enumerate(words) for _ in range(5 ** (k + 1)))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.group_variants(df, drop=2**40).collect()}
    assert got == {w: (words[k + 1] if k < 5 else None, words[5]) for k, w in enumerate(words)}


# --- chat formatting ------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_query(spark):
    rows = pq.read_table(f"{SF}/conversations.parquet").to_pylist()
    rows += [{"conv_id": -7, "turn": i, "role": r, "text": "</s>[INST] ok [/INST]"} for i, r in enumerate(("user", "assistant"))]
    convs = {}
    for r in sorted(rows, key=lambda r: (r["conv_id"], r["turn"])):
        convs.setdefault(r["conv_id"], []).append((r["role"], r["text"] or ""))
    got = {r["conv_id"]: r for r in E.queries()["op13_chat"](spark, SF).collect()}
    assert set(got) == set(convs)
    for c, turns in convs.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"]) == (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)))
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), sha(loss))


ODD_TEXTS = ["", " ", "\\", "\\\\", "<s>", "</s>", "[INST]", " [/INST]", "[INST] a [/INST]<s>b</s>", "<\\s>", "[", "<", "<<s>>", "\\<s>", "[\\INST]", "a\nb\r\n", " é\U0001F600",
             "[/TURN]", "[ROLE] x [/ROLE]", "[SYS]", "$1\\2", "<s", "[/INST", "x" * 20_000, None]


def test_texts_and_roles_read_back(spark):
    rnd = random.Random(3)
    rows, n = [], 0
    for c in range(60):
        for t in range(rnd.randint(1, 6)):
            rows.append((c, t, rnd.choice(["user", "assistant", "system", "tool", "", "<s>", "[/ROLE]", "a\nb", None]), rnd.choice(ODD_TEXTS)))
    rows += [(60, t, "assistant", "again") for t in (1, 1, 1)] + [(61, None, "user", "q"), (61, 0, "assistant", "a"), (None, 0, "user", "no id")]
    rows += [(62, t, "assistant" if t % 2 else "user", f"turn {t} [INST]") for t in range(2000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({"piece": F.lit("x"), "layout": F.lit(1), "record_id": F.lit(2)})
    out = chat.format_turns(chat.canonical_turns(df.repartition(5), "conv_id"))
    got = out.select("record_id", chat.read_back(F.col("formatted")).alias("turns"), chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"), "formatted").collect()
    expected = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, "user" if r[2] is None else r[2], r[3] or "")):
        expected.setdefault(c, []).append(("user" if r is None else r, x or ""))
    assert {r["record_id"] for r in got} == set(expected)
    for r in got:
        turns = expected[r["record_id"]]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(x for role, x in turns if role == "assistant")
        # the marks are the only control strings of the record
        marks = sum({"user": 2, "assistant": 2, "system": 2}.get(role, 3) for role, _ in turns)
        assert len(re.findall(r"[<\[](?:" + chat.CONTROL + ")", r["formatted"])) == marks


def test_layouts_are_chosen_by_the_paths_that_a_record_fills(spark):
    df = spark.createDataFrame(
        [(1, "p", "c", None, None, None, None, None, "sys", "z"), (2, None, None, "do", "with", "done", None, None, None, "z"), (3, None, None, "do", None, "done", None, None, None, None),
         (4, None, None, None, None, None, [("user", "hi"), (None, None), ("tool", "x")], None, None, "z"), (5, None, None, None, None, None, None, [("human", "q"), ("gpt", "a")], None, None),
         (6, "p", None, None, None, None, None, None, None, None), (7, None, None, None, None, None, [], None, None, None), (8, "p", "c", None, None, None, [("user", "hi")], None, None, None)],
        "id long, prompt string, completion string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, "
        "conversations array<struct<`from`:string,value:string>>, system string, mark string").withColumn("turns_0", F.lit(1))
    got = {}
    for r in chat.canonical_turns(df, "id").orderBy("record_id", "turn").collect():
        got.setdefault(r["record_id"], (r["layout"], []))[1].extend([(r["role"], r["text"])] if r["role"] is not None else [])
    assert got == {
        1: ("prompt_completion", [("system", "sys"), ("user", "p"), ("assistant", "c")]), 2: ("instruction", [("user", "do\n\nwith"), ("assistant", "done")]),
        3: ("instruction", [("user", "do"), ("assistant", "done")]), 4: ("messages", [("user", "hi"), ("user", ""), ("tool", "x")]),
        5: ("conversations", [("user", "q"), ("assistant", "a")]), 6: (None, []), 7: ("messages", []), 8: (None, [])}
    assert chat.canonical_turns(df.limit(0), "id").collect() == []
    assert [tuple(r) for r in chat.canonical_turns(spark.createDataFrame([(1, "x")], "id long, other string"), "id").collect()] == [(1, None, None, None, None)]


def test_turn_rows_are_chosen_by_their_fingerprint(spark):
    # the table has the columns of one row per turn, but the records say which of them they fill
    df = spark.createDataFrame(
        [(1, 0, "user", "a", None, None, None), (1, 1, "assistant", None, None, None, "s"), (1, None, None, None, None, None, None), (2, None, None, None, "p", "c", "s"),
         (3, 0, None, "x", "p", "c", None), (4, None, None, None, "p", None, None)],
        "id long, turn int, role string, text string, prompt string, completion string, system string")
    got = sorted((tuple(r) for r in chat.canonical_turns(df, "id").collect()), key=repr)
    assert got == sorted([
        (1, "turn_rows", 0, "user", "a"), (1, "turn_rows", 1, "assistant", ""), (1, "turn_rows", None, "user", ""),
        (2, "prompt_completion", 0, "system", "s"), (2, "prompt_completion", 1, "user", "p"), (2, "prompt_completion", 2, "assistant", "c"),
        (3, "turn_rows", 0, "user", "x"), (4, None, None, None, None)], key=repr)
    # the query's rows are told by their fingerprints as well
    plan = E.queries()["op13_chat"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert sha("role\ntext\nturn") in plan and sha("") in plan


def test_json_records_of_mixed_layouts(spark):
    lines = [(1, '{"prompt": "p", "completion": "c"}'), (2, '{"instruction": "i", "input": "x", "output": "o", "extra": {"a": 1}}'), (3, '{"messages": [{"role": "user", "content": "m"}, {"role": "assistant", "content": "n"}]}'),
             (4, '{"conversations": [{"from": "human", "value": "q"}]}'), (5, "not json"), (6, None), (7, "{}"), (8, '{"question": "q", "answer": "a"}')]
    got = {}
    for r in chat.canonical_json(spark.createDataFrame(lines, "id long, line string"), "id", "line").orderBy("record_id", "turn").collect():
        got.setdefault(r["record_id"], [r["layout"]]).append((r["role"], r["text"]))
    assert got == {1: ["prompt_completion", ("user", "p"), ("assistant", "c")], 2: ["instruction", ("user", "i\n\nx"), ("assistant", "o")], 3: ["messages", ("user", "m"), ("assistant", "n")],
                   4: ["conversations", ("user", "q")], 5: [None, (None, None)], 6: [None, (None, None)], 7: [None, (None, None)], 8: ["question_answer", ("user", "q"), ("assistant", "a")]}


def test_chat_formatting_runs_no_python(spark):
    plan = E.queries()["op13_chat"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
