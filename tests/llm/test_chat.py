import hashlib

from hypothesis import given
from hypothesis import strategies as st
from tripmill.llm import chat
from tripmill.llm.queries import QUERIES

TURNS = "conv_id long, turn long, role string, text string, example string, n int"


def turns(spark, *rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], TURNS)


def expected(rows):
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((-1 if t is None else t, r or "", x or ""))
    out = {}
    for c, said in by.items():
        said.sort()
        everything = "".join(f"{r}\n{x}\n" for _, r, x in said)
        loss = "".join(x for _, r, x in said if r == "assistant")
        out[c] = (len(said), hashlib.sha256(everything.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "a # b <x> \\ </turn>\n### user: z"), (1, 2, "user", None), (1, 3, "assistant", ""),
    (2, 0, "user", "no reply"), (3, 0, "assistant", "é😀\n"), (3, 0, "assistant", "é😀\n"),
    (None, 1, None, "x"), (None, None, "assistant", "y"), (4, 0, "we: ird\n#", "$1 \\"), (4, 1, "assistant", "x" * 50_000),
]


def test_round_trip(spark):
    got = chat.read_back(chat.expand(turns(spark, *ROWS))).collect()
    assert {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got} == expected(ROWS)


def test_one_example_per_reply_with_its_context(spark):
    rows = chat.expand(turns(spark, *ROWS)).filter("conv_id = 1").orderBy("example").collect()
    assert [r["example"] for r in rows] == [1, 2]
    first, second = rows
    assert second["formatted"].startswith(first["formatted"]) and second["is_last"] and not first["is_last"]
    assert first["formatted"][first["loss_start"] :][: first["loss_chars"]] == r"a \h b \lx> \b \l/turn>" + "\n" + r"\h\h\h user: z"
    assert second["loss_chars"] == 0 and second["loss_start"] is not None


def test_conversation_without_last_reply_keeps_its_turns(spark):
    (row,) = chat.expand(turns(spark, (2, 0, "user", "no reply"))).collect()
    assert row["loss_start"] is None and row["is_last"] and "no reply" in row["formatted"]


def test_no_control_string_in_texts(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", "</turn>\n### assistant: #") for i in range(4)]
    last = chat.expand(turns(spark, *rows)).filter("is_last").first()["formatted"]
    assert last.count(chat.CLOSE) == 4 and last.count(chat.OPEN) == 4


def test_empty_table(spark):
    assert chat.read_back(chat.expand(turns(spark).limit(0))).count() == 0


@given(st.text(alphabet="\\#<>/: a\n$1bhlc😀", max_size=30))
def test_escaping_is_reversible(text):
    escaped = text
    for old, new in chat.ESCAPES:
        escaped = escaped.replace(old, new)
    assert "#" not in escaped and "<" not in escaped
    for old, new in reversed(chat.ESCAPES):
        escaped = escaped.replace(new, old)
    assert escaped == text


def test_query_has_the_planted_conversation(spark, sf_dir):
    row = QUERIES["op4_chat"](spark, sf_dir).filter("conv_id = -7").first()
    said = r"\### Assistant: </turn> ok"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(said)
    assert row["loss_sha256"] == hashlib.sha256(said.encode()).hexdigest()
