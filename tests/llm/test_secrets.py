import hashlib
import random
import re

import numpy as np
import pytest

from civiclake.llm import secrets

ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def slow_rules(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans)), spans


TEXTS = [
    None, "", "é 😀 token = \"abcdef0123\" x", "secret: token: abcdefgh", "PassWord=abc", "api_key:=x=abcdefg APIKEY = 'zzzzzz'",
    "AKIA" + "A" * 15, "x AKIA" + "B7" * 8 + " y", "AKIAAKIA" + "C" * 12, "f" * 23, "F" * 30, "é" + "0f" * 12 + "g", "a1" * 40 + "=",
    "paßword=abcdefg toKen=abcdefg", "password==abcdefg", "token\n=abcdefg", "token = " + "0af" * 9, "word " * 30_000 + "secret=abcdefg",
]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = [(k, text, k, "clash") for k, text in enumerate(TEXTS)] + [(None, "token=abcdefg", 0, None), (2, TEXTS[2], 0, "x")]
    for k in range(100, 160):
        value = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((k, f"some words and token = \"{value}\" and more", k, "x"))
        longs = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(16, 30))) for _ in range(4)]
        longs.append("".join(rng.choice("0123456789") for _ in range(16)))
        rows.append((k + 100, " and then ".join(longs), k, "x"))
    rows.append((300, "plainwordsthatarelong and otherwordsthatarelong", 0, "x"))
    return spark.createDataFrame(rows, "doc_id long, text string, start int, kind string").repartition(3)


def test_rules_always_stay(docs):
    found = secrets.result(docs).collect()
    expected = sorted(
        (hashlib.sha256(slow_rules(row["text"])[0].encode()).hexdigest(),
         [sum(span[1] == kind for span in slow_rules(row["text"])[1]) for kind in range(3)]) for row in docs.collect()
    )
    assert sorted((row["base_sha256"], [row["n_assign"], row["n_access"], row["n_hex"]]) for row in found) == expected
    for row in found:
        base = ",".join(x for x in row["spans"].split(",") if not x.startswith("network"))
        assert hashlib.sha256(base.encode()).hexdigest() == row["base_sha256"]


def test_network_recall_and_precision(docs):
    network = secrets.fit(docs)
    assert network.recall >= secrets.RECALL
    text = b"here is 9fQ2xLm81Zt0RkVb7YcDs3Pw and then onlineshutteranddoors and"
    spans = secrets.find(text, network)
    assert [text[start:end] for start, kind, end in spans if kind == 3] == [b"9fQ2xLm81Zt0RkVb7YcDs3Pw"]


def test_long_candidates_are_read_whole():
    text = bytes(range(48, 58)) * 30
    seen = secrets.windows(text, 0, len(text))
    assert b"".join(w[secrets.AROUND:secrets.AROUND + secrets.STEP] for w in seen).startswith(text[:-secrets.VALUE])
    assert seen[-1][secrets.AROUND:-secrets.AROUND].rstrip(b"\0").endswith(text[-secrets.STEP:])


def test_redact(docs):
    masked = {row["doc_id"]: row["text"] for row in secrets.redact(docs, None).collect()}
    assert masked[2] == 'é 😀 [SECRET]" x' and masked[0] is None and masked[1] == "" and masked[300] == "plainwordsthatarelong and otherwordsthatarelong"


def test_no_documents(no_docs, edge_docs):
    assert secrets.result(no_docs).collect() == []
    assert secrets.result(edge_docs).count() == edge_docs.count()
    assert secrets.train([b"x" * secrets.WINDOW], []) is None


def test_short_values_that_no_rule_announces(docs):
    network = secrets.fit(docs)
    for value in (b"Tq0ub4W7r3x", b"x7Q-9fLz", b"Zk4+Qw"):
        text = b"the pwd: " + value + b" and then others"
        assert (9, 3, 9 + len(value)) in secrets.find(text, network)


def test_screen_agrees_with_the_network(docs):
    network = secrets.fit(docs)
    rng = random.Random(5)
    letters = "abcdefghij0123456789ABCXYZ/+ \n\":é"
    for size in (6, 10, 44, 45, 300, 5000, 70_000):
        text = "".join(rng.choice(letters) for _ in range(size)).encode()
        runs = secrets.candidates(text)
        starts, ends = (np.array([run[k] for run in runs], dtype=np.int64) for k in (0, 1))
        exact = np.array([network.logits(secrets.windows(text, *run)).max() for run in runs])
        for least in np.quantile(exact, (0.1, 0.5, 0.9)) if runs else ():
            network.least = least
            maybe = network.screened(text, starts, ends)
            assert maybe[exact >= least].all() and not maybe[(exact < least - 0.02) & (ends - starts <= 44)].any()
        first = [secrets.windows(text, *run)[0] for run in runs]
        rows = secrets._window_rows(text, starts, np.minimum(ends, starts + secrets.VALUE))
        assert [row.tobytes() for row in rows] == first


def test_candidates_at_the_threshold_are_found(docs):
    network = secrets.fit(docs)
    text = b"the pwd: x7Q-9fLz and then others"
    network.threshold = float(network.probabilities(secrets.windows(text, 9, 17))[0])
    network.least = float(network.logits(secrets.windows(text, 9, 17))[0])
    assert (9, 3, 17) in secrets.find(text, network)


def test_recall_through_find():
    rng = random.Random(6)
    letters = "0123456789abcdefABCDEFGHJKLMNPQRSTUVWXYZ"
    secret = [b" " * 16 + "".join(rng.choice(letters) for _ in range(20)).encode().ljust(48, b"\0") + b" " * 16 for _ in range(16)]
    plain = [b" " * 16 + "".join(rng.choice("etaoin") for _ in range(20)).encode().ljust(48, b"\0") + b" " * 16 for _ in range(16)]
    network = secrets.train(secret, plain)
    lowest = min(network.probabilities(secret))
    network.threshold, network.least = float(lowest), float(min(network.logits(secret)))
    assert all(secrets.find(row[:16] + row[16:64].rstrip(b"\0") + row[64:], network) for row in secret)


def test_each_window_is_shown_with_its_own_label():
    text = b"x http" + b"/abcdefg" * 12 + b"?token=" + b"0123456789abcdef" * 5 + b" y"
    starts, ends, labels = secrets._shown(text)
    first = text.index(b"0123")
    assert len(starts) == sum(len(secrets.windows(text, *run)) for run in secrets.candidates(text))
    assert labels.tolist() == [bool(end > first) for end in ends] and labels.any() and not labels[0]


def test_threshold_is_set_on_all_secrets_that_were_not_learned_from(docs, monkeypatch):
    monkeypatch.setattr(secrets, "HELD", 5)
    texts = [row["text"].encode() for row in docs.where("text is not null").collect()]
    labelled = set()
    for text in texts:
        starts, ends, labels = secrets._shown(text)
        rows = secrets._window_rows(text, starts, ends)
        labelled |= {(bool(end - start >= secrets.LONG), row.tobytes(), found) for start, end, row, found in
                     zip(starts[labels], ends[labels], rows[labels], secrets._hashes(rows[labels]))}
    network = secrets.fit(docs, sample=8)
    drawn = [min(8, sum(wide == long for wide, *_ in labelled)) for long in (False, True)]
    times = 16 // sum(drawn)
    assert network.held == (sum(drawn) // 2 + len(labelled) - sum(drawn)) * (1 + times)
    assert secrets.RECALL <= network.recall < 1 or network.held < 100
    logits = network.logits([content for _, content, _ in labelled])
    assert (logits >= network.least).mean() > 0.95
    assert secrets.fit(docs.repartition(7), sample=8).least == network.least


def test_place_of_a_share_is_exact(spark):
    rng = np.random.default_rng(8)
    logits = np.concatenate((rng.normal(0, 9, 3000), np.repeat(1.25, 900), [0.0, -0.0, 5e-324, -5e-324, 1e300, -1e300]))
    places = secrets._places(logits)
    table = spark.createDataFrame([(int(place),) for place in places[:2500]], "place long")
    for share in (0.0, 0.01, 0.5, 0.999):
        place, less, total = secrets._at_share(table, places[2500:], share)
        expected = np.sort(logits)[int(np.floor(share * len(logits)))]
        assert secrets._logit_at(place) == expected and total == len(logits) and less == (logits < expected).sum()
    none = table.where("false")
    assert secrets._logit_at(secrets._at_share(none, places, 0.5)[0]) == np.sort(logits)[len(logits) // 2]
