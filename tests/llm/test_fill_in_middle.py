"""Fill-in-middle against a plain re-reading of its rule, its inverse, and odd rows."""

from __future__ import annotations

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlark.llm import fill_in_middle as fim
from ledgerlark.session import ship_package


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_package(spark)


def by_hand(text: str, doc_id, rate=100, spm=50):
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


ODD = [
    "", "\n", "\n\n", "a", "a\n", "a\nb", "é\n漢字\n\U0001f600 x\r\n", "has <P> in it\nb", "<", "<S\n>", "P>\n<\n<M",
    "line\n" * 50_000, "x" * 3_000_000,
]


def test_rows_follow_the_rule_and_come_back(spark):
    rows = [(i, t) for i, t in enumerate(ODD * 6)] + [(1, None), (None, "a\nb\nc"), (None, None), (2, "a\nb"), (2, "a\nb")]
    df = spark.createDataFrame([(*r, "old", 7) for r in rows], "doc_id bigint, text string, output string, extra int")
    got = fim.restored(fim.fill_in_middle(df)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = r["text"] or ""
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == by_hand(text, r["doc_id"])
        assert r["restored"] == text and r["extra"] == 7
        assert fim.spelled([tuple(p) for p in r["pieces"]], text.encode()) == r["output"].encode()


def test_rates(spark):
    rows = [(i, f"one {i}\ntwo\nthree") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    for rate, spm in ((0, 50), (40, 100), (100, 0)):
        got = {r["doc_id"]: r["output"] for r in fim.fill_in_middle(df, rate=rate, spm_rate=spm).collect()}
        assert got == {i: by_hand(t, i, rate, spm)[4] for i, t in rows}


def test_empty_table(spark):
    assert fim.restored(fim.fill_in_middle(spark.createDataFrame([], "doc_id bigint, text string"))).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<PSM>\na", max_size=30), st.integers(0, 10**6))
def test_any_text_is_restored(text, doc_id):
    raw = text.encode()
    form, pieces = fim.transform(raw, doc_id, 7, 100, 50)[1::3]
    output = fim.spelled(pieces, raw)
    assert output.decode() == by_hand(text, doc_id)[4]
    assert fim.spelled(fim.restore(output, form), output) == raw
    assert fim.streamed_hash(pieces, raw) == hashlib.sha256(output).hexdigest()
