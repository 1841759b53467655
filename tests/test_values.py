"""Driver-side functions: months, shares, names, patterns."""

import re
from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st

from siltcomb.functions import values
from siltcomb.functions.regex import NeedsPython, checked, let_quotes_lead, to_jvm
from siltcomb.operators import sampling, sinks
from siltcomb.plans.cli import spec_of
from siltcomb.plans.spec import ExtractSpec


@pytest.mark.parametrize(("text", "month"), [("2010-01", (2010, 1)), ("2019-02", (2019, 2)), ("2019-2", (2019, 2)), ("2010-12", (2010, 12))])
def test_months(text, month):
    assert values.month_of(text) == month


@pytest.mark.parametrize("text", ["2010-12-01", "2010-13", "2010-00", "201-10", "1999-01", "2030-01", ""])
def test_no_months(text):
    with pytest.raises(ValueError):
        values.month_of(text)


def test_shares_and_tokens():
    assert values.share_of("0.25") == 0.25
    assert values.tagged_token("run,VERB,x") == ("run", "VERB")
    for bad in ("-0.1", "1.1", "x"):
        with pytest.raises(ValueError):
            values.share_of(bad)
    with pytest.raises(NotADirectoryError):
        values.folder_of("/no/such/folder")


@pytest.mark.parametrize(("name", "first", "last", "inside"), [
    ("RC_2010-03.zst", (2010, 1), (2010, 6), True), ("RC_2010-03.zst", (2010, 1), (2010, 3), True), ("RC_2010-03", (2010, 3), (2010, 3), True),
    ("RC_2011-03", (2010, 5), (2012, 1), True), ("RC_2011-03", (2001, 12), (2011, 3), True), ("RC_2009-03", (2010, 1), (2010, 6), False),
    ("RC_2020-03", (2010, 1), (2010, 6), False), ("RC_2020-03", None, None, True), ("notes.txt", None, None, False),
])
def test_within(name, first, last, inside):
    assert values.within(name, first, last) is inside


def test_pattern_from_file(tmp_path):
    (tmp_path / "p.txt").write_text("a|b")
    assert values.pattern_of(str(tmp_path / "p.txt")) == "a|b"
    assert values.pattern_of("a|c") == "a|c"


def test_quotes_may_lead():
    assert re.search(let_quotes_lead("^naja"), "&gt; so\n\nnaja")
    assert re.search(let_quotes_lead("(?i)^naja"), "> so\n\nNaja")
    assert not re.search(let_quotes_lead("^naja"), "so\n\nnaja")
    assert let_quotes_lead("naja") == "naja"
    assert let_quotes_lead("(?i)^naja", "compat") == "(?i)^naja"
    assert let_quotes_lead("^naja", "compat") == "^(>.+\n\n)*naja"
    with pytest.raises(ValueError):
        let_quotes_lead("^", "compat")


@pytest.mark.parametrize("p", [r"(a)?(?(1)b|c)", r"(?x) a b", r"[\W]", r"(?a)\w", r"\07"])
def test_left_to_python(p):
    with pytest.raises(NeedsPython):
        to_jvm(p, True)


def test_checked():
    assert checked("a+").spans_in_jvm
    assert not checked("a*").spans_in_jvm
    with pytest.raises(re.error):
        checked("(")


@pytest.mark.parametrize("bad", [
    {"output": None, "body_regex": "x"}, {}, {"names": ("a",)}, {"source": "user"}, {"body_regex": "x", "time_from": (2011, 1), "time_to": (2010, 1)},
    {"body_regex": "x", "pos": ("a", "B")}, {"body_regex": "x", "sample": 0.1, "reservoir": 3}, {"body_regex": "x", "reservoir": 0},
    {"body_regex": "x", "title_regex": "y"}, {"kind": "posts", "post_regex": "x", "toplevel": True}, {"kind": "posts", "body_regex": "x"},
])
def test_wrong_specs(bad):
    with pytest.raises(ValueError):
        ExtractSpec(**({"input": "comments", "output": "out"} | bad)).validate()


def test_guard_by_semantics():
    assert ExtractSpec("submissions", "o", post_regex="x").validate().table == "posts"
    with pytest.raises(ValueError):
        ExtractSpec("submissions", "o", post_regex="x", semantics="compat").validate()


def test_command_line():
    s = spec_of(["-I", "in", "--output", "o", "-CR", "x", "--case_sensitive", "--include-quoted", "-N", "a", "-N", "b", "--src", "user", "-F", "2010-01", "--dont_filter", "-RS", "5"])
    assert (s.names, s.case_sensitive, s.include_quoted, s.time_from, s.soft_filter, s.reservoir) == (("a", "b"), True, True, (2010, 1), False, 5)


def test_names_of_outputs():
    s = ExtractSpec("c", "o", source="user", names=("a", "b/c"), time_from=(2010, 1), popularity=5, toplevel=True, sample=0.5)
    assert sinks.name_of(s) == "comment_extraction_from_user_a;bc_from_2010-1_score_over_5_toplevel-only__sample-0.5_.csv"
    assert sinks.name_of(ExtractSpec("c", "o", kind="posts", return_all=True), at=datetime(2020, 1, 2, 3, 4, 5)).endswith("_executed-at_2020-01-02_03h-04m-05s.jsonl")
    assert sinks.review_name("x.jsonl") == "x_filtered-out_matches.jsonl"
    assert sinks.month_in("x_2010-03.csv") == (2010, 3)
    assert sinks.month_label((2010, 3)) == "March 2010"


def test_sample_sizes():
    assert [sampling.sample_size(0.5, n) for n in (1, 3, 5)] == [0, 2, 2]
    points = sampling.scan_points(0.2, [("a", 50), ("b", 100)])
    assert {k: len(v) for k, v in points.items()} == {"a": 9, "b": 19}
    with pytest.raises(IndexError):
        sampling.scan_points(0.1, [("a", 1)])


@given(st.integers(1, 8), st.integers(0, 60))
def test_reservoir_slots(n, total):
    slots = sampling.reservoir_slots(n, total)
    assert len(slots) == min(n, total) == len(set(slots))
    assert all(0 <= s < total for s in slots)
