import random

import pytest

from phenoloom.llm import quality


def texts(n, seed, least, most, words):
    """``n`` texts of ``words`` words or more, whose letters number ``least`` to ``most``."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=draw.randint(least, most)))
    return [" ".join(word() for _ in range(words + draw.randrange(words))) for _ in range(n)]


@pytest.fixture(scope="module")
def judged(spark):
    large = [(i, t, "en", "web") for i, t in enumerate(texts(400, 1, 2, 8, 60))]
    odd = "x#$ " * 3 + " ".join("#%&*$|<>" * 4 + str(i) for i in range(4000))

    def run(n):
        small = [(10_000 + i, t, "zz", "web") for i, t in enumerate(texts(n, 2, 30, 60, 500))]
        rows = [*large, *small, (99_999, odd, "zz", "web")]
        return {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}

    return {n: run(n) for n in (30, 98, 102)}


def test_small_language_with_unlike_statistics_is_kept(judged):
    rows = judged[30]
    assert all(r.kept for k, r in rows.items() if 10_000 <= k < 99_999)
    assert not rows[99_999].base_failed and not rows[99_999].kept


def test_verdicts_do_not_flip_at_a_size(judged):
    for k in range(10_000, 10_098):
        assert judged[98][k].distance == pytest.approx(judged[102][k].distance, rel=0.25, abs=0.5)
