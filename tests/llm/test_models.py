"""The fitted models against plain versions of their formulas, and the pipeline on odd tables."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from vaultgauge.llm import quality, url_filter

DATA = "/root/testdata/sf0.01"


class WittenBell:
    """Probability of a character after the four before it, interpolated over all shorter contexts."""

    def __init__(self, urls):
        self.counts = defaultdict(Counter)
        for url, weight in urls:
            text = "\u0002" * 4 + url + "\u0003"
            for i in range(4, len(text)):
                for order in range(5):
                    self.counts[text[i - order : i]][text[i]] += weight

    def probability(self, context, letter):
        p = 1 / 256
        for order in range(5):
            seen = self.counts.get(context[len(context) - order :])
            if seen:
                p = (seen[letter] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p

    def log_likelihood(self, url):
        text = "\u0002" * 4 + url + "\u0003"
        return sum(math.log(self.probability(text[i - 4 : i], text[i])) for i in range(4, len(text)))


def test_url_scores(spark):
    r = random.Random(7)
    hosts = ["a.org", "b.example.org", "x.com", "y.net", "z.io"]
    urls = [f"http://{r.choice(hosts)}/{r.choice(['fr', 'de', 'es', 'en', 'it'])}/{''.join(r.choices('abé1', k=r.randint(0, 6)))}" for _ in range(80)]
    urls += ["http://hot.net/it/page"] * 400 + [None] * 300 + ["", "no url", "http://a.org/" + "long" * 500]
    found = url_filter.judged(spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")).collect()
    assert len(found) == len(urls)
    verdicts = {x.url: x.rule and x.verdict for x in found}
    times = Counter(urls)
    yes, no = (WittenBell([(u, times[u]) for u, v in verdicts.items() if v == kind]) for kind in ("allow", "block"))
    expected = {u: (yes.log_likelihood(u) - no.log_likelihood(u)) / (len(u) + 1) if u else 0.0 for u in verdicts}
    assert len(yes.counts) > 50 and len(no.counts) > 50
    for x in found:
        assert x.score == pytest.approx(expected[x.url], abs=1e-9), x.url
    # One threshold divides the URLs without a rule.
    free = [(x.score, x.verdict) for x in found if not x.rule]
    allowed, blocked = ([s for s, v in free if v == kind] for kind in ("allow", "block"))
    assert not allowed or not blocked or max(blocked) < min(allowed)
    assert len({x.verdict for x in found if x.url == "http://hot.net/it/page"}) == 1


def test_discriminant(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.with_statistics(docs.join(labels, "doc_id").where("quality IN (0, 1)")).select("doc_id", "quality", "statistics")
    model = quality.fit(rows, "quality")
    seen = rows.toPandas()
    x, y = np.stack(seen["statistics"]), seen["quality"].to_numpy()
    scaled = (x - model.centre) / model.scale
    densities = []
    for c in (0, 1):
        own = scaled[y == c]
        s = np.cov(own.T, bias=True)
        d = len(s)
        s = (1 - quality.SHRINKAGE) * s + quality.SHRINKAGE * max(np.trace(s) / d, 1e-3) * np.eye(d)
        away = scaled - own.mean(axis=0)
        densities.append(-0.5 * np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away) - 0.5 * np.linalg.slogdet(s)[1])
    assert model.difference(x) == pytest.approx(densities[1] - densities[0], rel=1e-4, abs=1e-3)
    # Standard deviations around the class means, and the calibration, which only stretches and shifts.
    means = np.stack([x[y == c].mean(axis=0) for c in (0, 1)])
    assert model.means * model.scale + model.centre == pytest.approx(means, rel=1e-6, abs=1e-6)
    order = np.argsort(model.difference(x))
    assert (np.diff(model.score(x)[order]) >= -1e-12).all()


def test_pipeline_on_odd_tables(spark, tmp_path):
    texts = [
        None, "", " \n\t ", "a text", "a text", "A TEXT", "word " * 3000, "word " * 3000 + "more", None,
        " ".join(f"w{i}" for i in range(400)), " ".join(f"w{i}" for i in range(400)) + " end",
    ]
    docs = [(None if i == 4 else i, t, "en", "s", None, 1.0, "x") for i, t in enumerate(texts)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, digest string"
    labels = [(3, 1, 0), (6, 0, 1), (None, 1, 1), (9, None, None)]
    for name, rows in (("full", docs), ("empty", [])):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
    read = spark.read.parquet(f"{tmp_path}/full/documents.parquet")
    kept = read
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, f"{tmp_path}/full")
        assert kept.columns == read.columns and not Counter(kept.collect()) - Counter(before.collect()), name
    pieces = corpus_pipeline.run(spark, f"{tmp_path}/full")
    assert pieces.agg(F.sum("length")).first()[0] >= kept.count()
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
