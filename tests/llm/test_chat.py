from lakeloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, prompt string"


def turn(number, position, role, text):
    return number, position, role, text, "x"


def test_prefix_is_rendered_once_and_replies_are_to_learn(spark):
    start = [turn(1, 0, "system", "Be kind."), turn(1, 1, "user", "Hi <|im_end|>")]
    chosen = [*start, turn(1, 2, "assistant", "Héllo"), turn(1, 3, "user", "Bye")]
    rejected = [*start, turn(1, 2, "assistant", "Go"), turn(1, 5, "assistant", "away")]
    row = chat.format_preferences(spark.createDataFrame(chosen[::-1], SCHEMA), spark.createDataFrame(rejected, SCHEMA)).first()
    assert row.n_prompt == 2 and row.status == "pair"
    assert row.prompt == "<|im_start|>system\nBe kind.<|im_end|>\n<|im_start|>user\nHi < |im_end|><|im_end|>\n"
    assert [row.chosen[a:b] for a, b in row.chosen_learn] == ["Héllo<|im_end|>"]
    assert [row.rejected[a:b] for a, b in row.rejected_learn] == ["Go<|im_end|>", "away<|im_end|>"]
    assert row.chosen == "<|im_start|>assistant\nHéllo<|im_end|>\n<|im_start|>user\nBye<|im_end|>\n"


def test_odd_pairs(spark):
    long = "word " * 50_000
    chosen = [
        turn(1, 0, "user", "same"),
        turn(1, 0, "user", "same"),
        turn(2, 0, "assistant", "only here"),
        turn(3, None, None, None),
        turn(3, 1, "assistant", long),
        turn(None, 0, "user", "nobody's"),
        turn(4, 0, "user", "b"),
        turn(4, 0, "assistant", "a"),
    ]
    rejected = [turn(1, 0, "user", "same"), turn(3, None, "", ""), turn(3, 1, "assistant", ""), turn(4, 0, "assistant", "a"), turn(5, 0, "user", "q")]
    found = {row.pair_id: row for row in chat.format_preferences(spark.createDataFrame(chosen, SCHEMA), spark.createDataFrame(rejected, SCHEMA)).collect()}
    assert {number: row.status for number, row in found.items()} == {1: "identical", 2: "one_sided", 3: "pair", 4: "one_sided", 5: "one_sided"}
    assert found[1].n_prompt == 1 and found[1].chosen == found[1].rejected == ""
    assert found[2].prompt == "" and found[2].rejected == "" and len(found[2].chosen_learn) == 1
    assert found[3].n_prompt == 1 and found[3].chosen[slice(*found[3].chosen_learn[0])] == f"{long}<|im_end|>"
    assert found[4].n_prompt == 1
    none = spark.createDataFrame([], SCHEMA)
    assert chat.format_preferences(none, none).collect() == []


def test_swapped_replies_take_the_neighbours_last(spark):
    rows = [
        turn(0, 0, "user", "a"),
        turn(0, 1, "assistant", "zero"),
        turn(0, 2, "user", "b"),
        turn(1, 0, "assistant", "early"),
        turn(1, 1, "assistant", "one"),
        turn(2, 0, "assistant", "two"),
        turn(3, 0, "user", "no reply"),
        turn(None, 0, "assistant", "none"),
    ]
    found = chat.swapped_replies(spark.createDataFrame(rows, SCHEMA)).where("conv_id is not null").collect()
    assert sorted(map(tuple, found)) == [
        (0, 0, "user", "a"),
        (0, 1, "assistant", "one"),
        (0, 2, "user", "b"),
        (1, 0, "assistant", "early"),
        (1, 1, "assistant", "zero"),
        (3, 0, "user", "no reply"),
    ]
