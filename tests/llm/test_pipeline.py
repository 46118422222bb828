from __future__ import annotations

import random

import corpus_pipeline
from grantloom.llm import packing, quality, secret_scan, simhash, toxicity

from .helpers import PROSE, docs
from .test_filters import LABELS, toxic_corpus
from .test_simhash import plain_groups
from .test_tokens import check


def test_stages_in_order(spark, tmp_path):
    rows, labels = toxic_corpus(150)
    rng = random.Random(9)
    copy = " ".join(PROSE.split() + ["token=abcdef0123456789"])
    rows += [(200 + i, copy, "en", "s", len(copy)) for i in range(4)]
    rows += [(300, "too short", "en", "s", 9), (301, None, "en", "s", None), (302, "", None, None, 0)]
    rng.shuffle(rows)
    here = str(tmp_path)
    docs(spark, rows).write.parquet(f"{here}/documents.parquet")
    spark.createDataFrame(labels, LABELS).write.parquet(f"{here}/labels.parquet")
    found = corpus_pipeline.run(spark, here).collect()

    # the same stages over plain lists
    model = toxicity.fit(toxicity.sample(docs(spark, rows), spark.createDataFrame(labels, LABELS)))
    windows = toxicity.windows_of(model)
    left = [r for r in rows if toxicity.score(windows.shares([(r[1] or "").encode()])[0], model.limit) < 0.5]
    kept = {r.doc_id for r in quality.verdicts(docs(spark, left)).filter("kept").collect()}
    left = [r for r in left if r[0] in kept]
    assert not kept & {300, 301, 302} and 200 in kept
    prints = {r[0]: simhash.fingerprint(r[1].encode()) for r in left}
    groups = plain_groups(prints)
    left = [r for r in left if groups[r[0]] == r[0]]
    masked = [(r[0], secret_scan.mask(r[1], secret_scan.spans(r[1].encode()))) for r in left]
    assert "abcdef0123456789" not in dict(masked)[200]
    assert {r.doc_id for r in found} == {i for i, _ in masked}
    check(masked, found, packing.WINDOW)


def test_stage_columns(spark, tmp_path):
    rows, labels = toxic_corpus(60)
    spark.createDataFrame(labels, LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    df = docs(spark, rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, df, str(tmp_path)).schema.names == df.schema.names
        assert stage(spark, df.limit(0), str(tmp_path)).collect() == []


def test_near_copies_leave_the_corpus(spark, tmp_path):
    """Copies within three bits go; a text that shares a large passage with them stays."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(4000)]
    text = [rng.choice(words) for _ in range(3000)]
    edited = [" ".join([*text[:a], "new", *text[a + 1 :]]) for a in (20, 90, 150)]
    sharing = " ".join([*text[:1500], *[rng.choice(words) for _ in range(1500)]])
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate([*edited, sharing, " ".join(reversed(text))])]
    prints = {i: simhash.fingerprint(t.encode()) for i, t, *_ in rows}
    groups = plain_groups(prints)
    assert len({prints[i] for i in range(3)}) > 1 and {groups[i] for i in range(3)} == {0}
    left = corpus_pipeline.drop_near_copies(spark, docs(spark, rows), str(tmp_path))
    assert {r.doc_id for r in left.collect()} == set(groups.values()) == {0, 3, 4}
