import random

from emporium.llm import quotes as Q

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Links by scanning all earlier messages of the conversation."""
    rows = list(dict.fromkeys(rows))
    said = [Q.parse(r[3] or "") for r in rows]
    parent = {}
    for i, r in enumerate(rows):
        votes = {}
        for level, h, weight in said[i][1]:
            if level == 0 or r[0] is None or r[1] is None:
                continue
            earlier = [(rows[j][1], j) for j in range(len(rows))
                       if rows[j][0] == r[0] and rows[j][1] is not None and rows[j][1] < r[1]
                       and any(a == 0 and b == h for a, b, _ in said[j][1])]
            if earlier:
                turn = max(t for t, _ in earlier)
                votes[level, turn] = votes.get((level, turn), 0) + weight
        if votes:
            parent[i] = max(votes, key=lambda k: (-k[0], votes[k], k[1]))[1]
    return rows, said, parent


def by_turn(spark, rows):
    return {(r.conv_id, r.turn): r for r in Q.linked_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_parse_levels_attribution_and_nested_quotes():
    text = "Ann wrote:\n> First line\n>  Second   LINE\n>> older\n> > older two\n\nMy answer\nmore\n\n\n\nlast"
    body, units, quotes = Q.parse(text)
    assert body == "My answer\nmore\n\nlast"
    assert quotes == 2
    assert sorted(level for level, _, _ in units) == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    assert Q.quote_level("   >> > deep") == (3, " deep")
    assert Q.quote_level("    > code") == (0, "    > code")


def test_replies_threads_and_bodies(spark):
    rows = [(1, 0, "a", "Where is the red key?\nIt was here."), (1, 1, "b", "Is tea ready?"),
            (1, 2, "c", "> where is the  RED key?\nIn the drawer."),
            (1, 3, "d", "c wrote:\n>> Where is the red key?\n> In the drawer.\nThanks"),
            (1, 4, "e", "> Is tea ready?\nYes"), (2, 5, "f", "> Is tea ready?\nOther conversation")]
    got = by_turn(spark, rows)
    assert [got[1, t].reply_turn for t in range(5)] == [None, None, 0, 2, 1]
    assert [got[1, t].thread_turn for t in range(5)] == [0, 1, 0, 0, 1]
    assert [got[1, t].depth for t in range(5)] == [0, 0, 1, 2, 1]
    assert got[2, 5].reply_turn is None and got[2, 5].n_quotes == 1 and got[2, 5].n_linked == 0
    assert got[1, 3].body == "Thanks" and got[1, 3].chat == "<|d|>\nThanks\n"
    order = [r.turn for r in Q.linked_conversations(spark.createDataFrame(rows, SCHEMA)).collect() if r.conv_id == 1]
    assert order == [0, 2, 3, 1, 4]


def test_nulls_repeats_empty_table_and_extra_columns(spark):
    rows = [(None, 0, "a", "x"), (1, None, "a", "> x"), (1, 0, None, None), (1, 1, "a", "hm"), (1, 1, "a", "hm"),
            (1, 2, "b", "> hm\n" + "long " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], SCHEMA + ", mid int, body string")
    got = Q.linked_conversations(df).collect()
    assert len(got) == 5
    assert {(r.conv_id, r.turn, r.reply_turn, r.role) for r in got} == {
        (None, 0, None, "a"), (1, None, None, "a"), (1, 0, None, "unknown"), (1, 1, None, "a"), (1, 2, 1, "b")}
    assert Q.linked_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equals_brute_force_with_a_hot_passage(spark):
    rng = random.Random(5)
    said = ["yes", "no way", "the key is red", "ok then"]
    rows = []
    for i in range(900):
        lines = [("> " if rng.random() < .4 else ">> " if rng.random() < .2 else "") + rng.choice(said)
                 for _ in range(rng.randint(1, 4))]
        rows.append((rng.choice([1, 1, 2]), i, "r", "\n".join(lines)))
    rows, said, parent = brute(rows)
    got = by_turn(spark, rows)
    assert {k: v.reply_turn for k, v in got.items()} == {(r[0], r[1]): parent.get(i) for i, r in enumerate(rows)}
