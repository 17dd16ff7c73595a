import math
import random
from zlib import crc32

import numpy as np
import pytest

from civiclake.llm import langid


def text(letters, seed, count=200):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(count))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(k, text("aeinrst", k), "one", "clash") for k in range(40)] + [(k, text("oulmpqü", k), "two", None) for k in range(40, 80)]
    rows += [(80, None, "one", "x"), (81, "12 !?", "two", "x"), (82, text("aeinrst", 82), None, "x"), (None, "aei", "three", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string").repartition(3)


def slow_probability(counts, gram):
    """Interpolated Kneser-Ney, from its definition."""
    order = len(gram)
    by_order = {langid.ORDER: counts}
    for n in range(langid.ORDER - 1, 0, -1):
        by_order[n] = {}
        for longer in by_order[n + 1]:
            by_order[n][longer[1:]] = by_order[n].get(longer[1:], 0) + 1
    floor = 1 / (len(by_order[1]) + 1)

    def p(gram):
        if not gram:
            return floor
        same = {g: n for g, n in by_order[len(gram)].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        return max(same.get(gram, 0) - langid.DISCOUNT, 0) / total + langid.DISCOUNT * len(same) / total * p(gram[1:])

    assert order <= langid.ORDER
    return p(gram)


def test_arrays_hold_interpolated_probabilities():
    import pandas as pd

    texts = {"one": "abab cab abba", "two": "xyx abx yx"}
    rows, counts = [], {}
    for lang, of in texts.items():
        counts[lang] = {}
        for joined in langid.windows(of):
            letters = joined.tobytes().decode("utf-32-le")
            for k in range(len(joined) - langid.ORDER + 1):
                gram = letters[k:k + langid.ORDER]
                counts[lang][gram] = counts[lang].get(gram, 0) + 1
        rows.append(langid._fit_language(pd.DataFrame(
            {"lang": lang, "gram": list(counts[lang]), "n": list(counts[lang].values())}
        )))
    models = langid._arrays(pd.concat(rows))
    for probe in ("abba", "xab", "q", "a yx", "zzab"):
        joined = np.concatenate(list(langid.windows(probe)))
        letters = joined.tobytes().decode("utf-32-le")
        for k, lang in enumerate(models.languages):
            expected = sum(
                math.log(slow_probability(counts[lang], letters[at:at + langid.ORDER]))
                for at in range(len(letters) - langid.ORDER + 1)
            )
            assert models.log_probabilities(joined)[k] == pytest.approx(expected)


def test_predictions(spark, labelled):
    models = langid.fit(labelled)
    assert models.languages == ["one", "two"]
    found = {
        row["doc_id"]: row for row in
        langid.identify(labelled, models, columns=("language", "confidence", "good")).collect()
    }
    assert all(found[k]["language"] == ("one" if k < 40 else "two") and found[k]["good"] for k in range(80))
    assert found[82]["language"] == "one" and found[0]["score"] == "clash"
    for k in (80, 81):
        assert (found[k]["language"], found[k]["confidence"], found[k]["good"]) == ("und", 0.0, False)
    with pytest.raises(ValueError):
        langid.identify(labelled, models)


def test_foreign_text_is_rejected(labelled):
    models = langid.fit(labelled)
    assert not models.predict(text("жзйкцч", 5))[2]
    assert models.predict(text("aeinrst", 500))[2]


def test_nothing_to_learn(spark, no_docs, edge_docs):
    assert langid.result(no_docs).collect() == []
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert langid.result(unlabelled).first()["lang_pred"] == "und"
    assert langid.result(edge_docs).count() == edge_docs.count()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.result(docs).join(docs, "doc_id").collect()
    assert all(row["held_out"] == (crc32(str(row["doc_id"]).encode()) % 5 == 0) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert sum(row["lang"] == row["lang_pred"] for row in held) >= 0.98 * len(held)
    assert sum(row["accepted"] for row in rows) >= 0.99 * len(rows)


def test_blocks_do_not_change_symbols(monkeypatch):
    sample = "Ab  c, Dé!! 12 x\n y" * 20
    whole = np.concatenate(list(langid.symbols(sample)))
    monkeypatch.setattr(langid, "BLOCK", 7)
    assert (np.concatenate(list(langid.symbols(sample))) == whole).all()


def test_all_other_documents_calibrate(spark):
    copies = [(k, text("aeinrst", 0), "one") for k in range(100)]
    others = [(k, text("aeinrst" if k % 2 else "aeinrstbdghklmp", k), "one") for k in range(100, 300)]
    docs = spark.createDataFrame(copies + others, "doc_id long, text string, lang string").repartition(3)
    models = langid.fit(docs, documents=5)
    eligible = [row for row in copies + others if crc32(str(row[0]).encode()) % 5]
    found = [models.cross_entropy(row[1]) for row in eligible]
    # copies are fitted on at most once and as a whole; of the others all but five are calibrated on
    own = sorted((entropy[0] - models.mean[0]) * math.sqrt(n) for entropy, n in found)
    assert models.limit[0] >= langid.SLACK * own[-6] * 0.999
    assert sum(models.predict(row[1])[2] for row in eligible) == len(eligible)
    totals = sum(entropy[0] * n for entropy, n in found) / sum(n for _, n in found)
    without = [x for x, row in zip(found, eligible) if row[0] >= 100]
    alone = sum(entropy[0] * n for entropy, n in without) / sum(n for _, n in without)
    assert min(abs(models.mean[0] - totals), abs(models.mean[0] - alone)) < 0.05
