import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from pulsetrail.llm.chat import _ROLE, _TURN, Segment, escape, format_paths, read_formatted, reply_paths, unescape
from pulsetrail.llm.queries import TRICKY, all_queries

CONVERSATION = "conv_id bigint, turn bigint, role string, text string"
TREE = "tree string, node bigint, parent bigint, score double, conv_id bigint, role string, text string"
TEXT = st.lists(st.sampled_from(["\\", "#", "###", "</turn>", "\n", "a", ": ", "<", "é"])).map("".join) | st.text()


@given(TEXT, TEXT)
def test_turns_come_back(role, text):
    if any(0xD800 <= ord(c) < 0xE000 for c in role + text):
        return
    segment = Segment("t", 0, 0, 0)
    segment.add(role, text)
    segment.add("assistant", text)
    formatted = segment.row()[4]
    first = _TURN.match(formatted)
    assert (unescape(first[1]), unescape(first[2])) == (role, text)
    second = _TURN.match(formatted, first.end())
    assert second.end() == len(formatted) and unescape(second[2]) == text
    assert unescape(escape(role, _ROLE)) == role
    span = segment.row()[5][-1]
    assert unescape(formatted[span["start"] : span["end"]]) == text


def expected(rows):
    found = {}
    rows = [*rows, (-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        found.setdefault(conv, []).append((role or "", text or ""))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    out = {}
    for conv, turns in found.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return out


def run(spark, folder):
    rows = all_queries()["op10_chat"](spark, folder).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_odd_rows(spark, write):
    rows = [
        (1, 0, "user", None), (1, 2, "assistant", ""), (1, 1, None, "x"), (2, 0, "assistant", "y" * 2_000_000),
        (2, 1, "user", "z\n"), (2, 1, "user", "z\n"), (None, 5, "assistant", "no id"), (3, None, "a:b", "###"),
        (2, 4, "assistant", "###\\</turn>" * 1000),
    ]
    assert run(spark, write("conversations", rows, CONVERSATION)) == expected(rows)


def test_empty_table(spark, write):
    assert run(spark, write("conversations", [], CONVERSATION)) == expected([])


def test_long_conversation_comes_in_segments(spark):
    nodes = spark.createDataFrame([("t", i, i - 1 if i else None, 0.0, 1, "assistant", "é" * 300_000) for i in range(9)], TREE)
    whole = format_paths(nodes, reply_paths(nodes))
    assert whole.count() > 1
    assert read_formatted(whole).first().loss_chars == 9 * 300_000


def test_branches_by_score(spark):
    links = [(0, None, 1.0), (1, 0, 5.0), (2, 0, 1.0), (3, 1, 0.0), (4, 1, 2.0), (5, 2, 9.0), (6, 5, 0.0), (7, 99, 3.0)]
    nodes = spark.createDataFrame([("t", n, p, s, 1, "user", f"m{n}") for n, p, s in links], TREE)

    def paths(branches):
        found = {}
        for r in reply_paths(nodes, branches).orderBy("leaf", "depth").collect():
            found.setdefault(r.leaf, []).append(r.node)
        return found

    assert paths(None) == {3: [0, 1, 3], 4: [0, 1, 4], 6: [0, 2, 5, 6], 7: [7]}
    assert paths(2) == {4: [0, 1, 4], 6: [0, 2, 5, 6]}


def test_long_path(spark):
    nodes = spark.createDataFrame([("t", i, i - 1 if i else None, 1.0, 1, "user", "x") for i in range(300)], TREE)
    found = reply_paths(nodes).collect()
    assert sorted((r.depth, r.node) for r in found) == [(i, i) for i in range(300)]


def test_circle_is_an_error(spark):
    nodes = spark.createDataFrame([("t", 0, 1, 0.0, 1, "user", "x"), ("t", 1, 0, 0.0, 1, "user", "y")], TREE)
    with pytest.raises(ValueError):
        reply_paths(nodes)
