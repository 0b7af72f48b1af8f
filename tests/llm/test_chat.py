import hashlib

import duckdb
import pandas as pd
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tapelens.llm import chat, queries

TEXTS = st.text(st.sampled_from("\\|<>nab\n"), max_size=30)


@given(TEXTS)
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_parts(spark):
    rows = [
        (1, 0, "user", [("text", "see <|image|>", None, None), ("image", None, "a.png", 4), ("text", " and\\", None, None), ("document", None, "b.pdf", None)]),
        (1, 1, "assistant", [("audio", None, "c.wav", 3), ("text", "fine", None, None)]),
        (2, 0, "assistant", []),
        (2, 1, "assistant", None),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    got = sorted(chat.format_turns(df, parts=F.col("parts")).collect(), key=lambda r: (r.conv, r.turn))
    first = got[0]
    assert first.rendered == "<|im_start|>user\nsee <\\|image|><|image|> and\\\\<|document|><|im_end|>\n"
    assert [(first.rendered[a.offset :].startswith(f"<|{a.type}|>"), a.ref, a.tokens) for a in first.attachments] == [(True, "a.png", 1024), (True, "b.pdf", 600)]
    assert first.expanded_tokens == 1624 and got[1].expanded_tokens == 75
    assert got[1].start == len(first.rendered) and got[1].rendered[got[1].loss_start : got[1].loss_end] == "<|audio|>fine"
    assert got[3].start == len(got[2].rendered) and got[2].loss_start == got[2].loss_end


def test_unknown_parts_and_rows_in_any_order(spark):
    rows = [
        (1, 0, "user", [("video", None, "a.mp4", 7), ("text", "x", None, None), (None, "y", None, None), None]),
        (1, 1, "assistant", [("text", "one", None, None), ("hologram", None, None, None), ("image", None, "i.png", None)]),
        (1, 2, "assistant", [("text", "two", None, None)]),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    formatted = chat.format_turns(df, parts=F.col("parts"))
    got = sorted(formatted.collect(), key=lambda r: r.turn)
    assert got[0].rendered == "<|im_start|>user\n<|attachment|>xy<|im_end|>\n"
    assert [(a.type, a.ref, a.tokens) for r in got for a in r.attachments] == [("video", "a.mp4", 7), ("hologram", None, 1), ("image", "i.png", 256)]
    assert all(r.rendered[a.offset :].startswith(chat.OTHER if a.type not in chat.TOKENS else f"<|{a.type}|>") for r in got for a in r.attachments)
    again = spark.createDataFrame(got[::-1], formatted.schema).repartition(3)
    read = chat.read_back(again).collect()
    text = "user\n<|attachment|>xy\n" + "assistant\none<|attachment|><|image|>\n" + "assistant\ntwo\n"
    assert [(r.n_turns, r.turns_sha256, r.loss_sha256) for r in read] == [(3, sha(text), sha("one<|attachment|><|image|>two"))]


def test_odd_rows(spark):
    rows = [(None, 1, "user", "x"), (None, None, None, None), (3, 2, "assistant", ""), (3, 1, "assistant", "b\u00e9"), (3, 1, "assistant", "b\u00e9"), (4, 0, "sys\ntem", "y" * 100000), (5, 0, "user", "a"), (5, 0, "assistant", "a")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, rendered string")
    got = {r.conv: r for r in chat.read_back(chat.format_turns(df)).collect()}
    assert set(got) == {None, 3, 4, 5}
    assert got[None].turns_sha256 == sha("user\nx\n\n\n") and got[None].n_turns == 2
    assert got[3].turns_sha256 == sha("assistant\nb\u00e9\n" * 2 + "assistant\n\n") and got[3].loss_chars == 4
    assert got[4].turns_sha256 == sha("sys\ntem\n" + "y" * 100000 + "\n") and got[4].loss_sha256 == sha("")
    assert got[5].turns_sha256 == sha("assistant\na\nuser\na\n")
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_chat_format(spark, sf).toPandas()
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS FROM '{sf}/conversations.parquet'")
    want = con.sql(queries.oracle_sql()["op7_chat_format"]).df()
    order = lambda d: d[sorted(d)].sort_values("conv_id").reset_index(drop=True)
    pd.testing.assert_frame_equal(order(got), order(want), check_dtype=False)
    assert -1 in set(got.conv_id)
