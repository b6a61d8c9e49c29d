"""The pipeline against a brute-force version of its stages."""

from collections import Counter

import corpus_pipeline
from reglink.llm import frames
from test_llm_operators import PLAIN, SF, brute_hits, brute_lines, components


def test_pipeline(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = {r.doc_id: r.text for r in frames.read(spark, SF, "documents").collect()}

    def good(text):
        w = PLAIN.findall(text)
        win = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        hit = {i + o for i in range(len(w) - 2) if win[tuple(w[i:i + 3])] > 1 for o in range(3)}
        return len(w) >= 50 and 100 * len(hit) <= 50 * len(w)

    # Too few labels here for any certified cutoff: the base rule alone.
    want = {i: t for i, t in docs.items() if good(t)}
    want = brute_lines(sorted(want.items()))
    rows = sorted(want.items())
    _, root = components([t for _, t in rows], 5, 80, 100)
    first = {}
    for (i, _), r in zip(rows, root, strict=True):
        first.setdefault(r, i)
    want = {i: t for i, t in rows if i in first.values()}
    items = [(r.item_id, r.text) for r in frames.read(spark, SF, "benchmark").collect()]
    want = {i: want[i] for (i, *_, bad) in brute_hits(want.items(), items) if not bad}
    out = corpus_pipeline.run(spark, SF).collect()
    n = Counter()
    for r in out:
        n[r.doc_id] += r.length
    assert n == Counter({i: len(PLAIN.findall(t)) for i, t in want.items()})


def test_stages_on_empty_documents(spark):
    docs = frames.read(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if name != "packing":
            assert out.columns == docs.columns


def test_stages_keep_columns_and_extra_ones(spark):
    docs = frames.read(spark, SF, "documents").selectExpr("*", "doc_id AS key", "text AS removed", "1 AS n", "lang AS class")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.schema.names == docs.schema.names
        # The extra columns are those of their rows.
        assert out.count() > 0 and out.where("key IS DISTINCT FROM doc_id OR n <> 1 OR class IS DISTINCT FROM lang").count() == 0
