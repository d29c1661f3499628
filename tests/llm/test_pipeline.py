from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_lsh_forest import brute as grouped
from tests.llm.test_quality import brute as measured
from wheelhouse.llm import bpe, secret_scan

FOLDER = "/root/testdata/sf0.001"


def _kept(text):
    m = measured(text)
    return not (
        m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
        or 100 * m["n_dup_lines"] > 60 * m["n_lines"] or 10 * m["n_marks"] > 3 * m["n_words"]
        or m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 30 * m["n_words"]
    )


def test_run_equals_plain_steps(spark):
    docs = [r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    left = {r.doc_id: r for r in docs if _kept(r.text)}
    groups = grouped([(d, r.text) for d, r in left.items()], size=5)
    left = {d: r for d, r in left.items() if groups[d] == d}
    left = {d: r for d, r in left.items() if not contaminated(r.text, items)[1]}
    counts, pairs = {}, secret_scan.pairs_of(r.text or "" for r in left.values())
    for r in left.values():
        for start, end, value, decoy in secret_scan.candidates(r.text, secret_scan.known_spans(r.text)):
            key = secret_scan.length_class(end - start), decoy, secret_scan.score_bin(value, pairs)
            counts[key] = counts.get(key, 0) + 1
    last = secret_scan.thresholds([(*key, n) for key, n in counts.items()], pairs=pairs)
    tokens = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    want = {}
    for d, r in left.items():
        text = secret_scan.redacted(r.text, secret_scan.spans_of(r.text, last, pairs))
        ids = np.array(reference.encode_ordinary(text), "<u4")
        want[d] = (r.lang, r.source, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids.tobytes())
    got = {r[0]: (*r[1:6], bytes(r.token_bytes)) for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert got == want and len(got) > 50


def test_stages_keep_columns_and_take_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string, n_hit string, secrets string"
    rows = [(None,) * 8, (1, "", "en", None, 0, "x", "h", "t"), (2, " ".join(f"w{i}" for i in range(80)), None, "s", 5, None, "h", "t")]
    rows += [rows[2], (3, "password=abcdef12 " + " ".join(f"v{i}" for i in range(90)), "en", "s", None, "y", "h", "t")]
    for table in (rows, []):
        docs = spark.createDataFrame(table, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs_out = stage(spark, docs, FOLDER)
            assert docs_out.schema.simpleString() == docs.schema.simpleString(), name
            assert {tuple(r[5:]) for r in docs_out.collect()} <= {tuple(r[5:]) for r in table}, name
            docs = spark.createDataFrame([tuple(r) for r in docs_out.collect()], schema)
        assert sorted(r.doc_id for r in docs.collect()) == ([2, 3] if table else [])
        if table:
            assert all("abcdef12" not in r.text for r in docs.collect())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == (2 if table else 0)
