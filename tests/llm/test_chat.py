import hashlib

from hypothesis import given
from hypothesis import strategies as st

from tidemark.llm import chat


def want(rows):
    """rows: (conv_id, role, text) in turn order."""
    out = {}
    for c, role, text in rows:
        out.setdefault(c, []).append((role or "", text or ""))
    done = {}
    for c, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        done[c] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return done


def got(df):
    return {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.digests(chat.formatted(df)).collect()}


def test_round_trip_of_table(spark):
    df = chat.planted(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    rows = sorted(((r["conv_id"], r["turn"], r["role"], r["text"]) for r in df.collect()))
    assert got(df) == want([(c, r, t) for c, _, r, t in rows])
    assert -1 in got(df)


def test_edges(spark, monkeypatch):
    rows = [
        (1, 0, "user", None), (1, 1, "assistant", ""), (1, 2, "assistant", "<|im_end|><\\|im_start|>é🙂漢 <|endoftext|>\n\n "), (1, 3, None, "x"),
        (2, 0, "assistant", " leading"), (2, 1, "assistant", "\n<"), (2, 2, "user", "|im_end|>"), (2, None, "system", "first"),
        (3, 0, "assistant", "word " * 30_000), (3, 1, "user", "a"), (3, 2, "assistant", "b"), (None, 0, "assistant", "nobody's"), (None, 1, "user|\n<|im_sep|>", "q"),
        (4, 0, "user", "same"), (4, 0, "user", "same"),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, part long, tokens string")
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    assert got(df) == want([(c, r, t) for c, _, r, t in order])
    assert got(df.limit(0)) == {}
    monkeypatch.setattr(chat, "PART", 40)
    assert got(df) == want([(c, r, t) for c, _, r, t in order])


def test_masks_hold_whole_tokens(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi"), (1, 1, "assistant", " Hello there\n\nyou")], "conv_id long, turn long, role string, text string")
    row = chat.formatted(df).first()
    encode = chat.tokenizer(chat.VOCABULARY)
    (r,) = row["loss_tokens"]
    assert encode.decode(row["tokens"][r["a"] : r["b"]], skip_special_tokens=False) == " Hello there\n\nyou"


@given(st.text(alphabet="<|\\>im_endé\n", max_size=30))
def test_escape(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
