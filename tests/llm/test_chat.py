"""Reply trees against brute force; templates as exact round trips."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from skuflow.llm import chat, queries

MESSAGE = "tree_id long, node_id long, parent_id long, role string, text string, score double, path string, rank int"
ODD = ["</s>[INST] ok [/INST]", "\\", "[\\INST]", "\\[INST]", "<<s><<SYS>>", "<<TURN>>", "[[/INST]", "a\nb", "", "<<</ROLE>>\\", "\U0001f600<s>é"]


def slow_paths(messages, keep):
    by_id = {m[1]: m for m in messages}
    parents = {m[2] for m in messages if m[2] in by_id}
    out = {}
    for m in messages:
        if m[1] in parents:
            continue
        way, at, seen = [], m, set()
        while at is not None and at[1] not in seen:
            seen.add(at[1])
            way.append(at)
            at = by_id.get(at[2])
        if at is None:
            out.setdefault(m[0], []).append((-sum(x[5] or 0.0 for x in way), m[1], [x[1] for x in way[::-1]]))
    return sorted((t, leaf, i + 1, way) for t, found in out.items()
                  for i, (_, leaf, way) in enumerate(sorted(found)[:keep]))


def got_paths(df):
    found = {}
    for r in df.collect():
        found.setdefault((r["tree_id"], r["path"], r["rank"]), []).append((r["turn"], r["node_id"]))
    for way in found.values():
        assert [t for t, _ in sorted(way)] == list(range(len(way)))
    return sorted((*k, [n for _, n in sorted(way)]) for k, way in found.items())


@pytest.mark.parametrize("keep", [1, 3])
def test_paths_match_brute_force(spark, keep):
    rng = random.Random(keep)
    rows, node = [], 0
    for tree in range(12):
        ids = []
        for _ in range(rng.randrange(1, 40)):
            node += 1
            parent = rng.choice(ids[-3:]) if ids and rng.random() < 0.95 else rng.choice([None, 10_000 + node])
            rows.append((tree, node, parent, "user", "t", rng.choice([None, 0.0, 0.5, 1.0, -1.0]), "p", 1))
            ids.append(node)
    rows += [(50, 901, 902, "user", "round", 1.0, "p", 1), (50, 902, 901, "user", "round", 1.0, "p", 1),
             (50, 903, 901, "user", "hangs on the circle", 1.0, "p", 1)]
    rows += [(60, 2000 + i, 1999 + i if i else None, "user", "long", 0.25, "p", 1) for i in range(70)]
    got = got_paths(chat.best_paths(spark.createDataFrame(rows, MESSAGE), keep))
    assert got == slow_paths(rows, keep)


def test_hot_conversation_and_order(spark):
    """Half of the rows are one conversation; turns repeat, miss, and stand out of order."""
    rng = random.Random(5)
    rows = [(7, i, rng.choice(["user", "assistant"]), f"{i} {rng.choice(ODD)}") for i in range(900)]
    rows += [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([*ODD, None]))
             for c in range(40) for t in rng.sample([0, 1, 2, 2, 5, None], 5) if c != 7]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "no id"), (3, 1, "user", "twice"), (3, 1, "user", "twice")]
    rng.shuffle(rows)
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("score", F.lit("x"))
    got = {r["conv_id"]: r for r in chat.digest(chat.format_conversations(chat.chains(turns.repartition(7)))).collect()}
    want = {}
    for c, t, r, x in sorted(rows, key=lambda m: (m[1] is not None, m[1] or 0, m[2] is not None, m[2] or "", m[3] is not None, (m[3] or "").encode())):
        want.setdefault(c, []).append((r or "", x or ""))
    assert got.keys() == want.keys()
    for c, said in want.items():
        loss = "".join(x for r, x in said if r == "assistant")
        assert got[c]["n_turns"] == len(said)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in said).encode()).hexdigest(), c
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_texts_come_back_exactly(spark):
    rng = random.Random(2)
    bits = ["[", "]", "<", ">", "/", "\\", "s", "INST", "SYS", "ROLE", "TURN", "[INST]", "</s>", "<<SYS>>", "<</ROLE>>", "\n", "é"]
    texts = ODD + ["".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    rows = df.withColumn("back", chat.plain(F.col("e"))).collect()
    assert [r["back"] for r in rows] == texts
    marks = [m for pair in chat.MARKS.values() for m in pair] + [chat.ROLE_OPEN, chat.ROLE_TEXT, chat.ROLE_CLOSE]
    assert not [r["e"] for r in rows if any(m in r["e"] for m in marks)]


def test_repeated_ids_and_empty_tables(spark):
    rows = [(1, 1, None, "user", "b", 0.0, "p", 1), (1, 1, None, "user", "a", 0.0, "p", 1), (1, 2, 1, "assistant", "c", 0.0, "p", 1),
            (1, None, None, "user", "no place", 0.0, "p", 1)]
    df = spark.createDataFrame(rows, MESSAGE)
    one = chat.format_conversations(df).collect()
    assert [(r["formatted"], r["n_turns"]) for r in one] == [("[INST]a[/INST]<s>c</s>", 2)]
    assert [(s["text"], s["loss"]) for s in one[0]["segments"] if s["loss"]] == [("c", True)]
    assert chat.format_conversations(df.limit(0)).collect() == []
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_conversations(chat.chains(empty)).collect() == []


def test_registered_query_has_the_planted_conversation(spark):
    got = {r["conv_id"]: r for r in queries.op11_chat(spark, "/root/testdata/sf0.001").collect()}
    odd = "</s>[INST] ok [/INST]"
    assert got[-1]["turns_sha256"] == hashlib.sha256(f"user\n{odd}\nassistant\n{odd}\n".encode()).hexdigest()
    assert got[-1]["loss_sha256"] == hashlib.sha256(odd.encode()).hexdigest()
