import re

import corpus_pipeline as pipeline
from presslake.llm.mixing import mix
from presslake.llm.quality import allowed_rows, fit, quality
from presslake.llm.secrets import redacted, scan_text
from presslake.llm.simhash import fingerprint
from tests.llm.test_simhash import brute_components
from tests.llm.test_tokens import check_pieces

DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def key(rows):
    return sorted((str(x.doc_id), x.text or "", x.lang or "", x.source or "", str(x.n_chars)) for x in rows)


def test_stages_and_run_against_brute_force(spark, sf, scratch, vocabulary):
    from presslake.llm.tokens import Encoder
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "secret_scan", "mix_sources", "pack_windows"]
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{scratch}/{name}")
        seen.append((docs.collect(), spark.read.parquet(f"{scratch}/{name}")))
        docs = seen[-1][1]
        assert k == 4 or docs.columns == DOCS
    # what the classifier scores below a half goes, the rest stays as it is
    model = fit(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), allowed_rows())
    scores = {x.id: x.score for x in quality(spark.read.parquet(f"{sf}/documents.parquet"), model).collect()}
    before, after = seen[0]
    assert key(after.collect()) == key(x for x in before if scores[x.doc_id] >= 0.5)
    # one document of each component: the smallest id
    before, after = seen[1]
    roots = brute_components([(x.doc_id, fingerprint(x.text, 3) & (1 << 64) - 1) for x in before], 3)
    assert key(after.collect()) == key(x for x, r in zip(before, roots) if x.doc_id == r)
    # secrets give way, everything else is as before
    before, after = seen[2]
    expected = {x.doc_id: redacted(x.text, scan_text(x.text)) for x in before}
    assert {x.doc_id: x.text for x in after.collect()} == expected
    assert all(x.n_chars == len(x.text) for x in after.collect() if x.text != {b.doc_id: b.text for b in before}[x.doc_id])
    # each document as often as the mix takes it
    before, after = seen[3]
    copies = {x.id: x.copies for x in mix(spark.read.parquet(f"{scratch}/secret_scan")).collect()}
    assert key(after.collect()) == key(x for x in before for _ in range(copies[x.doc_id]))
    # every copy's ids lie in pieces once
    before, after = seen[4]
    check_pieces(after.collect(), [(x.doc_id, x.text) for x in before], Encoder(vocabulary), 1024)
    assert all(len(x.ids) == 4 * x.length for x in after.collect())
    assert sorted(map(str, pipeline.run(spark, sf).drop("sequence_id", "offset").collect())) == sorted(
        map(str, after.drop("sequence_id", "offset").collect()))


def test_edge_rows(spark, edge, empty, sf):
    for name, stage in pipeline.STAGES:
        out = stage(spark, edge, sf)
        assert out.count() >= 1 and stage(spark, empty, sf).count() == 0
        if name != "pack_windows":
            assert out.columns == edge.columns


def test_clean_documents_pass_the_filtering_stages(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {x.doc_id: x.quality for x in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {x.doc_id for x in pipeline.quality_classifier(spark, docs, sf).collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept for i in good) >= 0.99 * len(good)
    clean = pipeline.secret_scan(spark, docs, sf).collect()
    changed = {x.doc_id for x in clean} - {x.doc_id for x in clean if x.text in {d.text for d in docs.collect()}}
    assert all(re.search(r"\[(assign|access|hex|jwt|pem|der|sshkey)\]", x.text) for x in clean if x.doc_id in changed)
