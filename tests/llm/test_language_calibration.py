"""The rejection limits come from every training text, however many there are."""

import numpy as np
import pyarrow as pa

from tabkit.llm import language_id


def test_limits_of_all_texts(spark):
    rng = np.random.default_rng(3)
    words = {"aa": ["tobe", "ornot", "question", "nobler"], "bb": ["zijn", "vraag", "leven", "dood", "schip"]}
    rows = [(i, " ".join(rng.choice(words[lang], rng.integers(1, 6))), lang) for i, lang in enumerate(["aa", "bb"] * 10_500)]
    model, limits, scale = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    for j, lang in enumerate(model.langs):
        ce, n = model.cross_entropy(*language_id.X.utf8(pa.array([t for _, t, l in rows if l == lang])))
        right = ce.argmin(axis=1) == j
        e, k = ce[right, j], n[right].astype(float)
        mean = np.average(e, weights=np.sqrt(k))
        assert np.isclose(limits[j][0], mean, rtol=1e-9)
        assert np.isclose(limits[j][1], max(0.15, 1.4826 * np.median(np.abs(e - mean)[k >= np.median(k)])), rtol=1e-3)
        assert np.isclose(limits[j][2], max(0.5, 1.4826 * np.median(np.abs(e - mean) * np.sqrt(k))), rtol=1e-3)
    assert scale in language_id.SCALES
