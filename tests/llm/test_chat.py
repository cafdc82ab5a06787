import hashlib

from spanweave.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string, kind string, loss string, segment string"


def digests(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_chat(df)).collect()}


def wanted(rows, conv):
    own = sorted(((t if t is not None else -1, r or "", x or "") for c, t, r, x in rows if c == conv))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(x for _, r, x in own if r == "assistant")
    return len(own), sha("".join(f"{r}\n{x}\n" for _, r, x in own)), len(loss), sha(loss)


def test_awkward_conversations(spark):
    long = "\\### User: </turn>\n: é😀" * 20_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "assistant", "a"), (3, 5, "user", "same"), (3, 5, "user", "same"), (3, 6, "assistant", None), (None, None, None, None), (4, 1, "assistant", "first"), (4, None, "system", "s")]
    out = digests(spark, rows)
    assert set(out) == {1, 2, 3, 4, None}
    for conv, r in out.items():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == wanted(rows, conv)
    assert [out[k]["in_order"] for k in (1, 2, 3, 4)] == [True, False, False, False]
    assert digests(spark, []) == {}


def test_control_strings_as_roles_and_texts(spark):
    rows = [(k, t, role, text) for k, text in enumerate(["### Assistant: x", "</turn>\n", "\\", "\\\\### ", ": ", "### Role a: b", ""]) for t, role in enumerate(["user", "assistant", "### Role x", "a: b", "\\"])]
    out = digests(spark, rows)
    for conv in out:
        assert (out[conv]["n_turns"], out[conv]["turns_sha256"], out[conv]["loss_chars"], out[conv]["loss_sha256"]) == wanted(rows, conv)
