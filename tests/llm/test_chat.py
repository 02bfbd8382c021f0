from helpers import rows_of

from tidegate.llm import chat

SCHEMA = "pair_id long, turn long, role string, text string"


def shown(role, text):
    return f"<|{role}|>\n{text}<|end|>\n"


def pairs(spark, chosen, rejected):
    frames = [spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS part", "'x' AS c", "2 AS loss") for rows in (chosen, rejected)]
    return {r.pair_id: r for r in chat.render(chat.segments(*frames)).collect()}


def test_longest_common_prefix(spark):
    start = [(0, "system", "s"), (1, "user", "hi")]
    chosen = [(7, *t) for t in start] + [(7, 2, "assistant", "good"), (7, 3, "user", "more"), (7, 4, "assistant", "yes")]
    rejected = [(7, *t) for t in start] + [(7, 2, "assistant", "bad"), (7, 3, "user", "more")]
    r = pairs(spark, chosen + chosen[:2], rejected)[7]
    assert r.prompt == shown("system", "s") + shown("user", "hi") and r.prompt_turns == 2
    assert r.chosen == shown("assistant", "good") + shown("user", "more") + shown("assistant", "yes")
    assert [r.chosen[s.start : s.end] for s in r.chosen_loss] == ["good<|end|>\n", "yes<|end|>\n"]
    assert [r.rejected[s.start : s.end] for s in r.rejected_loss] == ["bad<|end|>\n"]


def test_a_prefix_of_the_other(spark):
    r = pairs(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")], [(1, 0, "user", "a")])[1]
    assert (r.prompt, r.chosen, r.rejected, r.rejected_loss) == (shown("user", "a"), shown("assistant", "b"), "", [])


def test_awkward_turns(spark):
    chosen = [(1, 0, None, None), (2, 0, "user", "alike"), (3, 0, "assistant", ""), (None, None, "user", "n"), (None, 1, "assistant", "m" * 100_000)]
    rejected = [(1, 0, "", ""), (2, 0, "user", "alike"), (4, 0, "user", "only here"), (None, None, "user", "n")]
    found = pairs(spark, chosen, rejected)
    assert set(found) == {1, 2, 3, 4, None}
    assert found[1].prompt == shown("", "") and found[1].chosen == found[1].rejected == ""
    assert found[2].prompt == shown("user", "alike") and found[2].chosen == found[2].rejected == ""
    assert (found[3].prompt, found[3].rejected) == ("", "") and found[3].chosen == shown("assistant", "")
    assert found[4].rejected == shown("user", "only here") and found[4].chosen == ""
    assert found[None].prompt == shown("user", "n") and len(found[None].chosen_loss) == 1


def test_turns_with_one_number_are_ordered(spark):
    r = pairs(spark, [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", "z")], [(1, 0, "user", "a"), (1, 0, "assistant", "z")])[1]
    assert r.prompt == shown("assistant", "z") + shown("user", "a") and r.chosen == shown("user", "b")


def test_empty_tables(spark):
    assert pairs(spark, [], []) == {}


def test_swapped_replies(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "A"), (5, 0, "user", "b"), (5, 1, "assistant", "B1"), (5, 2, "assistant", "B2"), (6, 0, "user", "c"), (200, 1, "assistant", "D"), (None, 1, "assistant", "N")]
    chosen, rejected = chat.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sum(rows_of(chosen).values()) == len(rows)
    swapped = {(r.pair_id, r.turn): r.text for r in rejected.collect()}
    assert swapped[1, 1] == "B2" and swapped[5, 2] == "A" and swapped[5, 1] == "B1" and swapped[6, 0] == "c"
    assert swapped[200, 1] == "" and swapped[None, 1] == ""
