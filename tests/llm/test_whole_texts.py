"""Features that were counted on the beginning of a text."""

from rollout_quality.llm import toxicity


def test_kinds_of_stems_count_all_hits():
    known = toxicity._Words({"zork": 4.0})
    text = "zorkel " * 1500 + " ".join(f"zork{'abcdefghij'[i]}" for i in range(10))
    assert toxicity.describe(text, known)[toxicity.NAMES.index("stem_kinds")] == 11
