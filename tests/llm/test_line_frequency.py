import re
from collections import Counter

import pytest
from hypothesis import given
from hypothesis import strategies as st

from presswork.llm import line_frequency as lf


def brute(text):
    words = re.findall(lf.WORD, text)
    lines = [x for x in text.split("\n") if re.search(lf.WORD, x)]
    three = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) if three[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return [
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)),
        len(inside),
    ]


@given(st.text(alphabet="ab \n\t#é\x0b", max_size=80))
def test_measures(text):
    assert lf.measure(text.encode())[0] == brute(text)


def test_long_text():
    text = "a b c " * 200_000
    assert lf.measure(text.encode())[0] == [600_000, 600_000, 0, 0, 600_000]


@pytest.fixture
def table(spark):
    """Host h has 40 texts; 30 end in one line, 5 of them hold little else."""
    own = lambda i, n: " ".join(f"w{i}x{j}" for j in range(n))
    line = " ".join(f"menu{j}" for j in range(40))
    rows = [(i, own(i, 60 if i >= 5 else 30) + ("\n  " + line.upper() if i < 30 else ""), "h") for i in range(40)]
    rows += [(100 + i, own(100 + i, 30) + "\n" + line, None) for i in range(5)]
    copy = own(999, 80) + "\n" + own(998, 30)
    rows += [(200 + i, copy, "h") for i in range(50)]
    rows += [(300, None, "h"), (301, "", "g"), (None, own(7, 70), "g"), (None, own(7, 70), "g")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"kept": lf.F.lit(1), "row": lf.F.lit(2)})


def test_depleted_documents_go(table, small_batches):
    out = lf.judge(table.repartition(6)).collect()
    kept = {r["doc_id"]: r["kept"] for r in out if r["doc_id"] is not None}
    assert len(out) == table.count()
    assert [i for i in range(40) if not kept[i]] == [0, 1, 2, 3, 4]
    # The same line is rare on another host; copies of a text count once.
    assert all(kept[100 + i] for i in range(5)) and all(kept[200 + i] for i in range(50))
    assert not kept[300] and not kept[301]
    assert [r["kept"] for r in out if r["doc_id"] is None] == [True, True]


def test_rejects_nothing_it_should_not_and_empty_table(table):
    assert lf.judge(table, min_docs=31).filter("NOT kept").count() == 2
    assert lf.judge(table.limit(0)).count() == 0
