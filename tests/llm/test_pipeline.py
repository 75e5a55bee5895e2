from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from kpiloom.llm import lines, mixing, pieces, pipeline, toxicity
from tests.llm.conftest import documents, edited, prose
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_minhash import brute as brute_near


def saved(tmp_path, docs, labels):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path)


def test_run_against_a_brute_force_version(spark, rng, tmp_path):
    common = [prose(rng, 14) for _ in range(3)]
    texts = []
    for _ in range(150):
        base = "\n".join(prose(rng, rng.randint(30, 60)) for _ in range(rng.randint(1, 3)))
        if rng.random() < 0.3:
            base += "\n" + rng.choice(common) + rng.choice(["", ".", "!"])
        texts += [base] + [edited(rng, base, rng.randint(0, 1)) for _ in range(rng.choice([0, 0, 1, 2]))]
    texts += ["", None, common[0]]
    toxic = [rng.random() < 0.15 and t is not None and len(t) > 200 for t in texts]
    for i, bad in enumerate(toxic):
        if bad:
            texts[i] = " ".join(w + rng.choice([" zorkum", " fleemish", ""]) if rng.random() < 0.3 else w for w in texts[i].split(" "))
    docs = documents(spark, texts, sources=[rng.choice("aab") for _ in texts]).withColumn("extra", F.lit("x"))
    labels = spark.createDataFrame([(i, 1, int(b)) for i, b in enumerate(toxic)], "doc_id long, quality int, toxic int")
    folder = saved(tmp_path, docs, labels)
    got = corpus_pipeline.run(spark, folder).collect()

    # Stage 1 by the operator's scores, held against the planted labels.
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((scores[i] >= 0.7) == toxic[i] for i in held) >= 0.95 * len(held)
    rows = [(i, t) for i, t in enumerate(texts) if scores[i] < 0.7]
    # Stage 2: lines of classes that enough documents share.
    classes = brute_lines(rows, 2, 20)
    documents_of = {}
    for d, _, _, _, cd, cl, _ in classes:
        documents_of.setdefault((cd, cl), set()).add(d)
    gone = {(d, n) for d, n, _, _, cd, cl, kept in classes if not kept and len(documents_of[cd, cl]) >= pipeline.LINE_DOCUMENTS}
    after = []
    for i, t in rows:
        if not any(d == i for d, _ in gone):
            after.append((i, t))
        elif (left := "\n".join(s for n, s in enumerate(t.split("\n")) if (i, n) not in gone)).strip():
            after.append((i, left))
    assert 0 < len(gone)
    # Stage 3: the smallest doc_id of each group.
    near = brute_near(after)
    kept = [(i, t) for i, t in after if near[i][1] == i]
    assert len(kept) < len(after)
    # Stage 4: repetitions by the mix of what is left.
    taken = {r.doc_id: r.repetitions for r in mixing.mix(documents(spark, [t for _, t in kept], [docs_source for docs_source in sources_of(docs, kept)], [i for i, _ in kept])).collect()}
    sizes = {i: len((t or "").split()) for i, t in kept}
    want = Counter({i: taken[i] if sizes[i] else 1 for i, _ in kept})
    assert Counter(r.doc_id for r in got) == +want
    # Stage 5: the library's ids.
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.default_model())
    text = dict(kept)
    for r in got:
        ids = library.encode(text[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def sources_of(docs, kept):
    by = {r.doc_id: r.source for r in docs.collect()}
    return [by[i] for i, _ in kept]


def test_stages_keep_columns_nulls_repeated_rows_and_no_rows(spark, rng, tmp_path):
    text = prose(rng, 60)
    docs = documents(spark, [None, "", text, text, text, prose(rng, 30)], ["s", None, "s", "s", "s", "t"], ids=[1, None, 3, 3, None, 6]).withColumns({"size": F.lit(9), "score": F.lit("y")})
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    folder = saved(tmp_path, docs, labels)
    for empty in (False, True):
        now = docs.limit(0) if empty else docs
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, now, folder)
            rows = out.collect()
            assert not empty or rows == []
            if name != "tokens":
                assert out.columns == docs.columns
                now = spark.createDataFrame(rows, docs.schema)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line-dedup", "near-dedup", "mixture", "tokens"]


def test_the_line_stage_removes_what_op10_does_not_keep(spark, rng):
    shared, own, near = prose(rng, 12), prose(rng, 9), prose(rng, 15)
    docs = documents(spark, [f"{shared}\n{prose(rng, 20)}", f"{prose(rng, 20)}\n{shared}", f"{own}\n{own}\n{prose(rng, 20)}\n{own}", f"{near}\n{own}x", f"{prose(rng, 20)}\n{near}.", own])
    want = {}
    for r in lines.line_classes(docs).collect():
        if r.kept:
            want.setdefault(r.doc_id, set()).add(r.line)
    before = {r.doc_id: r.text.split("\n") for r in docs.collect()}
    got = {r.doc_id: r.text.split("\n") for r in pipeline.line_stage(spark, docs, "").collect()}
    assert got == {d: [before[d][n] for n in sorted(kept)] for d, kept in want.items()}
    assert sorted(got) == [0, 1, 2, 3, 4] and [len(got[d]) for d in sorted(got)] == [2, 1, 2, 1, 1]
