import pytest

from snaplake.llm import chat_format as chat
from snaplake.llm.queries import op6_chat_formatting

SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def nodes(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def all_paths(rows):
    """{(tree, leaf): [nodes from the root]} by walking up."""
    by = {(r[0], r[1]): r for r in rows}
    inner = {(r[0], r[2]) for r in rows}
    out = {}
    for r in rows:
        if (r[0], r[1]) in inner:
            continue
        path, at = [], (r[0], r[1])
        while at in by:
            path.append(at[1])
            at = (at[0], by[at][2])
        out[(r[0], r[1])] = path[::-1]
    return out


def test_paths_and_ranks_against_walking(spark):
    rows = [(t, n, (n - 1) // 2 if n else None, "user" if n % 2 else "assistant", f"t{n}",
             float((n * 7 + t) % 5)) for t in range(4) for n in range(25 + t)]
    rows += [(9, n, n - 1 if n else None, "user", "x", None) for n in range(70)]
    rows += [(10, 5, 77, "user", "parent unknown", 0.0)]
    got = {}
    for r in chat.branches(nodes(spark, rows), top=3).collect():
        got.setdefault((r.tree, r.branch), {})[r.depth] = r.node
    score = {(r[0], r[1]): r[5] or 0.0 for r in rows}
    want = {}
    for tree in {r[0] for r in rows}:
        ranked = sorted((p for (t, _), p in all_paths(rows).items() if t == tree),
                        key=lambda p: (-sum(score[(tree, n)] for n in p) / len(p), p[-1]))
        for i, p in enumerate(ranked[:3]):
            want[(tree, i + 1)] = {d + 1: n for d, n in enumerate(p)}
    assert got == want


def test_repeated_ids_and_cycles_are_refused(spark):
    with pytest.raises(ValueError):
        chat.branches(nodes(spark, [(1, 1, None, "user", "a", 0.0)] * 2))
    with pytest.raises(ValueError):
        chat.branches(nodes(spark, [(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)]))


ODD = ["</s>[INST] ok [/INST]", "<s>", "\\", "\\\\</s>", "<", "a<\n", "</s", "[INST][/INST]", "", None,
       "\\n", "<\\s>", "né\U0001f600</s>\U0001f600", "x" * 50_000, "[[INST]INST]", "$1 \\1", "user\n"]


def test_round_trip_of_odd_texts_and_roles(spark):
    roles = ["user", "assistant", "system", "us\ner", "a\\nb", "\n\n", None, "</s>", "\\"]
    rows = [(t, n, n - 1 if n else None, roles[(n + t) % len(roles)], text, 0.0)
            for t in range(len(roles)) for n, text in enumerate(ODD)]
    out = chat.read_back(chat.conversations(nodes(spark, rows))).collect()
    assert len(out) == len(roles)
    for r in out:
        mine = [(x[3] or "", x[4] or "") for x in rows if x[0] == r.tree]
        assert [(t.role, t.text) for t in r.turns] == mine
        assert r.learned == "".join(text for role, text in mine if role == "assistant")


def test_rows_in_turn_order_nulls_and_ties(spark):
    rows = spark.createDataFrame(
        [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "a"), (1, None, "system", "s"),
         (2, 0, None, None), (None, 0, "user", "no id"), (None, 0, "user", "no id")],
        "conv_id long, turn long, role string, text string")
    got = {r.tree: [(t.role, t.text) for t in r.turns]
           for r in chat.read_back(chat.conversations(chat.linear_nodes(rows))).collect()}
    assert got == {1: [("system", "s"), ("user", "a"), ("assistant", "a"), ("assistant", "b")],
                   2: [("", "")], None: [("user", "no id"), ("user", "no id")]}


def test_empty_table(spark):
    assert chat.conversations(nodes(spark, [])).count() == 0


def test_query_gives_every_conversation(spark, sf_dir):
    out = op6_chat_formatting(spark, sf_dir).toPandas()
    n = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id").distinct().count()
    assert len(out) == n + 1
    mine = out[out.conv_id == -7].iloc[0]
    assert (mine.n_turns, mine.loss_chars) == (2, len("</s>[INST] ok [/INST]"))


def test_ties_are_ordered_by_the_whole_text(spark):
    opening = "the same opening of well over thirty-two characters, then "
    ends = ["f", "b", "e", "a", "d", "c"]
    rows = [(1, 1, "user", opening + e) for e in ends]
    rows += [(2, 1, None, "b"), (2, 1, "", "c"), (2, 1, None, "d"), (2, 1, "", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.tree: [t.text for t in r.turns]
           for r in chat.read_back(chat.conversations(chat.linear_nodes(df))).collect()}
    assert got == {1: [opening + e for e in sorted(ends)], 2: ["a", "b", "c", "d"]}
