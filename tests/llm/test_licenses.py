import random
import re
import time

import pytest

from spanweave.llm import licenses


def accepts(markup, words, k):
    """Whether the template matches words from place k on, by a regular expression over words."""
    form = ""
    for part in re.findall(r"<<optional>>|<<end>>|<<any \d+>>|[^\s<]+", markup):
        form += "(?:" if part == "<<optional>>" else ")?" if part == "<<end>>" else rf"(?:\S+ ){{0,{part[5:-2].strip()}}}" if part.startswith("<<") else part + " "
    m = re.match(form, " ".join(words[k:]) + " ")
    return m is not None and m.end() > 0


def test_templates_against_a_regular_expression_from_every_place():
    rng = random.Random(3)
    markups = {
        "far": "<<optional>>a<<end>> w0 w1 w2 <<any 2>> " + " ".join(f"x{k}" for k in range(30)) + " <<any 2>> " + " ".join(f"y{k}" for k in range(40)),
        "nested": "<<optional>>the <<optional>>very <<any 2>><<end>> first<<end>> one <<any 1>> two",
        "wild": "<<any 3>> one two <<optional>>three<<end>>",
    } | {k: v if isinstance(v, str) else v[0] for k, v in licenses.TEMPLATES.items()}
    scanner = licenses.Scanner(markups)
    for _ in range(500):
        words = []
        for _ in range(rng.randint(0, 3)):
            own = re.sub(r"<<any \d+>>", lambda m: " ".join(rng.choice(["odd", "one", "w0"]) for _ in range(rng.randint(0, int(m[0][5:-2]) + (rng.random() < 0.1)))), rng.choice(list(markups.values())))
            own = re.sub("<<optional>>|<<end>>", " ", own).split()
            if own and rng.random() < 0.3:
                del own[rng.randrange(len(own))]
            words += own + rng.choice([[], ["the"], ["one"]])
        found = {label for label, m in markups.items() if any(accepts(m, words, k) for k in range(len(words)))}
        assert set(scanner.scan(" ".join(words))[5].split(",")) - set(licenses.PHRASES.values()) - {""} == found


def test_regions_far_before_the_longest_run():
    markup = "<<optional>>a<<end>> w0 w1 w2 <<any 2>> " + " ".join(f"x{k}" for k in range(30)) + " <<any 2>> " + " ".join(f"y{k}" for k in range(40))
    text = "w0 w1 w2 " + " ".join(f"x{k}" for k in range(30)) + " " + " ".join(f"y{k}" for k in range(40))
    assert licenses.Scanner({"far": markup}).scan("so " + text)[5] == "far"
    with pytest.raises(ValueError):
        licenses.Scanner({"none": "<<optional>>a<<end>> <<any 3>>"})


def test_many_places_take_time_in_proportion():
    scanner, seconds = licenses.Scanner(), []
    for n in (10_000, 80_000):
        began = time.time()
        assert scanner.scan("mit license " * n)[:4] == (2 * n, n, 0, 2 * n - 2)
        seconds.append(time.time() - began)
    assert seconds[1] < 20 * seconds[0] + 1


def test_awkward_rows(spark):
    schema = "doc_id long, text string, score string, labels string"
    rows = licenses.scan_licenses(spark.createDataFrame([(1, None, "x", "y"), (1, "", "x", "y"), (None, "MIT\xa0LICENSE mit\x00license", "x", "y"), (2, "cc by", "x", "y"), (2, "cc by", "x", "y")], schema)).collect()
    assert [tuple(r)[1:7] for r in rows] == [(0, 0, None, None, "", "")] * 2 + [(3, 1, 1, 1, "mit", "mit")] + [(2, 1, 0, 0, "cc-by", "cc-by")] * 2
    assert licenses.scan_licenses(spark.createDataFrame([], schema)).count() == 0
