import hashlib
import random
import re
import time

from spanweave.llm import pii

SCHEMA = "doc_id long, text string, spans string, n_ip string"
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def plain(text):
    """Base spans by Python's own engine: (start, order of kind, kind, end)."""
    out = []
    for k, (kind, form) in enumerate(FORMS.items()):
        for m in re.finditer(form, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and max(map(int, m[0].split("."))) <= 255 or kind == "card" and 12 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 9 <= len(digits) <= 15:
                out.append((m.start(), k, kind, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def test_base_against_brute_force(spark):
    rng = random.Random(1)
    pieces = ["a.b@c.de", "x@y", "@", "192.168.0.1", "1.2.3.4.5.6.7.8", "300.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 555-5657", "+123", "é", "😀", " ", "\n", "-", "7", "0a1b2c3d4e5f60718293a4b5c6d7e8f9", 'token = "', "."]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], SCHEMA)
    for r in pii.find_pii(df).collect():
        own = plain(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in FORMS] == [sum(s[2] == k for s in own) for k in FORMS]
        assert r["base_sha256"] == hashlib.sha256(listed(own).encode()).hexdigest()
        assert set(listed(own).split(",")) - {""} <= set(r["spans"].split(",")) and r["n_spans"] == r["n_more"] + len(own) == len(r["spans"].split(",")) - (not r["spans"])


def test_awkward_rows(spark):
    mail = plain("a@b.cd")
    rows = pii.find_pii(spark.createDataFrame([(1, None, None, None), (1, "", None, None), (None, "a@b.cd", "x", "y"), (None, "a@b.cd", "x", "y"), (2, "a@b.cd", "x", "y"), (2, "a@b.cd", "x", "y")], SCHEMA)).collect()
    assert len(rows) == 6 and sorted(r["spans"] for r in rows) == ["", ""] + [listed(mail)] * 4
    assert pii.find_pii(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_take_time_in_proportion(spark):
    seconds = []
    for n in (4_000, 16_000):
        df = spark.createDataFrame([(1, "some.one@mail.org and id4711x; " * n, None, None)], SCHEMA)
        began = time.time()
        assert pii.found_in(df, "doc_id", "text").selectExpr("size(base) AS b", "size(more) AS m").first()[:] == (n, n)
        seconds.append(time.time() - began)
    assert seconds[1] < 8 * seconds[0] + 5


def test_keys_induce_a_pattern_that_finds_other_secrets(spark):
    rng = random.Random(2)
    key = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    texts = [f'words around token = "{key()}" and {k} more' for k in range(6)] + ['other token = "hunter2-is/Not+hex==" here', "plain text of 2024 and abc123 only"]
    rows = {r["doc_id"]: r for r in pii.find_pii(spark.createDataFrame([(i, t, None, None) for i, t in enumerate(texts)], SCHEMA)).collect()}
    start = texts[6].index("hunter2")
    assert rows[6]["spans"] == f"id:{start}:{start + 20}" and rows[7]["spans"] == "" and all(rows[k]["n_more"] == 1 for k in range(7))
