"""What Python workers hold from one operator to the next."""

import pyarrow as pa
import pytest

from orderloom.llm import near_dedup, worker

TEXTS = pa.array(["one two three four five six", "", "one two three four five six"])
GROUP = pa.table(
    {
        "node": pa.array([b"a"], pa.binary()),
        "root": pa.array([b"a"], pa.binary()),
        "left": [True],
        "right": [True],
        "text": ["one"],
    }
)


@pytest.mark.parametrize(
    "visit",
    [
        lambda: list(near_dedup._signed(30, 5).func(iter([TEXTS]))),
        lambda: list(near_dedup._similarities(iter([(TEXTS, TEXTS)]))),
        lambda: near_dedup._block_links(GROUP, 0.8),
    ],
)
def test_near_dedup_gives_back_earlier_tables(spark, visit):
    worker.keep("an earlier operator", lambda: [0] * 1000)
    assert worker.kept() == ["an earlier operator"]
    visit()
    assert worker.kept() == []


def test_one_operator_at_a_time():
    built = []
    for key in ("a", "a", "b", "a"):
        assert worker.keep(key, lambda key=key: built.append(key) or key) == key
    assert built == ["a", "b", "a"] and worker.kept() == ["a"]
    worker.release()
    assert worker.kept() == []
