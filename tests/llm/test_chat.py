"""Chat formatting: exact round trips and digests."""

import hashlib
from collections import defaultdict

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import chat
from lexmill.llm.queries import op9_chat_formatting

PIECES = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "[/INST]", " [/INST]", "\\", "<", "s>", "a", "é", "𝒳", "\n", " "]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=5))
def test_assembly_round_trip(rows):
    role, text = (chat.escape(pa.array(x, pa.string())) for x in zip(*rows))
    const = lambda s: pa.array([s] * len(rows), pa.string())
    made, begins = chat.assemble([const(chat.OPEN), role, const(chat.ROLE_END), text, const(chat.CLOSE)])
    for r, row, a, b in zip(rows, made.to_pylist(), begins[3], begins[4]):
        assert chat.parse_turn(row) == r
        assert chat.unescape(row.encode()[a:b].decode()) == r[1]
        assert row.count("<s>") == 1 and row.count("</s>") == 1 and row.count("[INST]") == 1 and row.count("[/INST]") == 1


def expected(rows):
    by = defaultdict(list)
    for c, t, role, text in rows:
        made = [chat.escape(pa.array([x or ""], pa.string()))[0].as_py() for x in (role, text)]
        by[c].append((t is not None, t or 0, chat.OPEN + made[0] + chat.ROLE_END + made[1] + chat.CLOSE, role or "", 0, text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(x[5] for x in turns if x[3] == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{x[3]}\n{x[5]}\n" for x in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def digests(rows):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_odd_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, None, None), (2, None, "assistant", ""), (None, 0, "assistant", "x\\"), (3, 0, "user", "<s>" * 9)]
    rows += [(4, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(25_000)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    got = chat.read_back(chat.format_turns(df)).collect()
    assert digests(got) == expected(rows) and len(got) == 5
    assert chat.read_back(chat.format_turns(df.limit(0))).collect() == []


def test_query_on_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    said = "</s>[INST] ok [/INST]"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    assert digests(op9_chat_formatting(spark, "/root/testdata/sf0.01").collect()) == expected(rows)


def test_long_texts_are_copied_as_ranges():
    import pyarrow as pa

    from lexmill.llm.chat import LONG_BYTES, assemble

    parts = [["a" * (LONG_BYTES + 1), "", "b"], ["x", "é" * LONG_BYTES, "y" * LONG_BYTES]]
    got, begins = assemble([pa.array(p) for p in parts])
    assert got.to_pylist() == [a + b for a, b in zip(*parts)]
    assert begins[1].tolist() == [LONG_BYTES + 1, 0, 1]
