"""Languages, scores, mixing, archives, neighbours, licences and the pipeline."""

import base64
import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from headgate.llm.language import identify, keep_identified
from headgate.llm.lattice import VOCABULARY, Lattice, first_weights, pieces_of, score
from headgate.llm.licences import TEXTS, scan
from headgate.llm.mixing import domain_labels, fit_rates, mix, with_rates
from headgate.llm.permutation import nearest_neighbours
from headgate.llm.tables import read
from headgate.llm.warc import MAGIC, archived, read_warc, write_warc


def test_languages(spark, sd, odd_documents, no_documents):
    documents = read(spark, sd, "documents")
    true = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    rows = identify(documents).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [true[r.doc_id] == r.lang_pred for r in rows if r.held_out]
    assert len(rows) == len(true) and sum(held) / len(held) > 0.95
    odd = {r.doc_id: r.lang_pred for r in identify(odd_documents).collect()}
    assert [odd[k] for k in (3, 4, 5)] == ["und"] * 3 and {odd[k] for k in (None, 1, 6, 7, 8, 9)} == {"en"}
    assert identify(no_documents).count() == 0 and keep_identified(no_documents).count() == 0
    left = keep_identified(odd_documents)
    assert left.columns == odd_documents.columns
    assert {(r.doc_id, r.score) for r in left.collect()} == {(k, 0.5) for k in (None, 1, 2, 6, 7, 8, 9)}


def test_mixture_of_two_languages(spark, sd):
    documents = read(spark, sd, "documents").where("n_chars > 800")
    en, de = (documents.where(f"lang = '{x}'").first().text for x in ("en", "de"))
    from headgate.llm.language import learn, proportions

    model = learn(documents)
    share = dict(zip(model.languages, proportions(model.likelihood, en[:700] + " " + de[:700])[0].tolist(), strict=True))
    assert share["en"] > 0.25 and share["de"] > 0.25 and sum(share.values()) == pytest.approx(1)


def plain_lattice(weights, stop, word):
    text, go = "▁" + word, 1 - stop
    reach = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            if (piece := text[i:j]) in weights and not piece.startswith("<0x"):
                reach[j] += reach[i] * math.exp(weights[piece]) * go
        reach[j] += reach[j - 1] * math.prod(math.exp(weights[f"<0x{b:02X}>"]) * go for b in text[j - 1].encode())
    return math.log(reach[-1] * stop)


def test_lattice_sums_all_segmentations():
    weights = first_weights(pieces_of(VOCABULARY))
    assert sum(map(math.exp, weights.values())) == pytest.approx(1)
    words = ["the", "", "a", "unbelievable", "straße", "漢字", "<0x41>", "zzzz", "word" * 20]
    got = Lattice(weights, 0.25).log_probabilities(words)
    assert got == pytest.approx([plain_lattice(weights, 0.25, w) for w in words])
    pieces, spelt = Lattice(weights, 0.25).expected(["the"])
    assert (pieces > 0).sum() > 1 and pieces.sum() + spelt.sum() > 1


def test_scores(spark, sd, odd_documents, no_documents):
    for documents in (read(spark, sd, "documents"), odd_documents):
        texts = [(r.doc_id, (r.text or "").encode().lower().split()) for r in documents.collect()]
        held = {d: zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in texts}
        counts = Counter()
        for d, w in texts:
            if not held[d]:
                counts.update([*w, None])
        n, v = sum(counts.values()), len(counts)
        want = Counter()
        for d, w in texts:
            base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in [*w, None])
            want[(d, held[d], len(w) + 1, sum(counts[x] > 0 for x in [*w, None]), n, round(base, 4))] += 1
        rows = score(documents, block=7).collect()
        assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
    assert score(no_documents).count() == 0


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.3, 0.3], 400)
    n = rng.integers(1, 900, 400)
    table = spark.createDataFrame([(int(a), x.tolist()) for a, x in zip(n, p, strict=True)], "n_tokens long, p array<double>")
    targets = [0.5 * n.sum(), 0.3 * n.sum(), 0.2 * n.sum()]
    rate = np.ones(400)
    for step in fit_rates(table, targets):
        rate = np.maximum(0, rate - p @ np.array(step))
    assert rate @ (n[:, None] * p) == pytest.approx(targets, rel=1e-4) and rate.min() >= 0


def test_mixing(spark, sd, odd_documents, no_documents):
    # The smallest tables have too few labels to tell the domains apart, so that no rates meet the targets.
    larger = f"{os.path.dirname(sd)}/sf0.01"
    labels = domain_labels(read(spark, larger, "labels"))
    rows = mix(read(spark, larger, "documents"), labels).collect()
    whole = sum(r.n_tokens for r in rows)
    assert sum(r.rate * r.n_tokens * r.p_good for r in rows) == pytest.approx(0.9 * whole, rel=0.01)
    assert all(r.rate >= 0 and abs(r.p_good + r.p_low + r.p_toxic - 1) < 1e-9 for r in rows)
    odd = spark.createDataFrame([(1, None, 1), (2, 0, 0), (None, 1, 0), (2, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    assert {tuple(r) for r in domain_labels(odd).collect()} == {(1, "toxic"), (2, "low")}
    joined = with_rates(odd_documents, domain_labels(odd))
    assert joined.columns[: len(odd_documents.columns)] == odd_documents.columns and joined.count() == odd_documents.count()
    assert mix(no_documents, labels).count() == 0
    assert {round(r.p_good, 6) for r in mix(odd_documents, labels.limit(0)).collect()} == {round(1 / 3, 6)}


def test_rates_of_documents_with_columns_of_their_names(spark, odd_documents):
    documents = odd_documents.selectExpr("*", "-7 AS rate", "-1 AS N_Tokens", "'y' AS mixed_rate", "2 AS _of")
    rows = with_rates(documents, domain_labels(spark.createDataFrame([(1, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")))
    assert rows.columns[: len(documents.columns)] == documents.columns
    assert rows.columns[len(documents.columns) :] == ["mixed_n_tokens", "p_good", "p_low", "p_toxic", "mixed_mixed_rate"]
    assert all((r.rate, r.N_Tokens, r.mixed_rate, r["_of"]) == (-7, -1, "y", 2) and r.mixed_mixed_rate >= 0 for r in rows.collect())


def test_payloads_are_read_back(spark, tmp_path):
    htmls = ["<p>é</p>", MAGIC * 2 + "x", "", "y" * 5000]
    pages = spark.createDataFrame([(i, "http://a", h) for i, h in enumerate(htmls)], "page_id long, url string, html string")
    for compression in ("gzip", "none"):
        write_warc(pages, f"{tmp_path}/{compression}", compression)
        got = {int(r.page_id): bytes(r.payload).decode() for r in read_warc(spark, f"{tmp_path}/{compression}").collect()}
        assert got == dict(enumerate(htmls))


def test_few_labels_tell_domains_apart(spark, sd):
    labels = domain_labels(read(spark, sd, "labels"))
    rows = mix(read(spark, sd, "documents"), labels).collect()
    whole = sum(r.n_tokens for r in rows)
    for domain, share in {"good": 0.9, "low": 0.09, "toxic": 0.01}.items():
        assert sum(r.rate * r.n_tokens * r[f"p_{domain}"] for r in rows) == pytest.approx(share * whole, abs=0.01 * whole)
    toxic = {r.doc_id for r in labels.where("domain = 'toxic'").collect()}
    assert sum(r.rate for r in rows if r.doc_id in toxic) < 0.8 * len(toxic)


def test_archives(spark):
    fake = MAGIC + "WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    htmls = ["<p>é</p>", "<p>é</p>", None, "", fake, f"x{fake}{fake}", MAGIC, "\r\n\r\n" + MAGIC * 3, "x" * 100_000, fake, "\r\n\r\n"]
    rows = [(i + 3 if i else None, f"http://a/{i}\r\nX: é", h, 1, "k") for i, h in enumerate(htmls)] + [(9, None, "twice", 1, "k")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int, kind string").repartition(3)
    want = Counter()
    for payload in {r[2] or "" for r in rows}:
        ids = sorted((r[0] for r in rows if (r[2] or "") == payload), key=lambda x: (x is None, x or 0))
        data = payload.encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        for k, i in enumerate(ids):
            want[(i, len(data), digest, "revisit" if k else "response", ids[0] if k else None)] += 1
    assert Counter(map(tuple, archived(pages).collect())) == want
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert Counter(map(tuple, archived(pages, "none").collect())) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert archived(pages.limit(0)).count() == 0


def test_neighbours(spark, sd):
    rows = [(r.vec_id, r.embedding) for r in read(spark, sd, "embeddings").collect()]
    zero = [0.0] * 64
    odd = [(10_000, None), (10_020, zero), (10_040, [float("nan")] * 64), (10_060, [None] * 64), (10_080, []), (None, rows[0][1]), (10_100, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows + odd + rows[:3] + [(20_001, rows[0][1])]], "vec_id long, embedding array<float>, rank int, score double")
    ids = np.array([i for i, _ in rows] + [20_001, 10_100])
    x = np.array([v for _, v in rows] + [rows[0][1], [1.0, 2.0] + [0.0] * 62], dtype=np.float32).astype(float)
    got = {}
    for r in nearest_neighbours(table, shard=100, queries=10).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert set(got) == {i for i in ids.tolist() if i % 20 == 0}
    hit = total = 0
    for q, found in got.items():
        at = int(np.nonzero(ids == q)[0][0])
        s = (x * x[at]).sum(axis=1)
        best = [k for k in np.lexsort((ids, -s)) if k != at][:20]
        assert sorted(found) == list(range(1, len(best) + 1)) and all(v == s[np.nonzero(ids == i)[0][0]] for i, v in found.values())
        hit, total = hit + len({int(ids[k]) for k in best} & {i for i, _ in found.values()}), total + len(best)
    assert hit / total >= 0.9
    assert nearest_neighbours(table.limit(0)).count() == 0


def test_licences(spark):
    files = [("a/x.py", "Header.\nReleased under the MIT License.\nbody of many other words"), ("a/LICENSE", "Licensed under the Apache License, Version 2.0."),
             ("a/b/c/y", "nothing here"), ("a/b/c/y", "nothing here"), ("ab/z", "also nothing"), ("top", "All rights reserved.\nand more words. And more."), (None, "All rights reserved."),
             ("a/b/n", None), ("a/b/e", ""), ("d/long", "word " * 50_000)]
    rows = scan(spark.createDataFrame([(p, t, "x", 0.0) for p, t in files], "path string, text string, licence string, cosine double")).collect()
    want = Counter({("a/x.py", "MIT", "own", None): 1, ("a/LICENSE", "Apache-2.0", "own", None): 1, ("a/b/c/y", "Apache-2.0", "inherited", "a"): 2, ("ab/z", None, None, None): 1,
                    ("top", "proprietary", "own", None): 1, (None, "proprietary", "own", None): 1, ("a/b/n", "Apache-2.0", "inherited", "a"): 1,
                    ("a/b/e", "Apache-2.0", "inherited", "a"): 1, ("d/long", None, None, None): 1})
    assert Counter((r.path, r.licence, r.source, r.from_folder) for r in rows) == want
    assert scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_licences_of_full_texts(spark):
    full = {(name, len(text) > 1500): text for name, text in TEXTS}
    mit = "Copyright (c) 2020 Some One\n\n" + full["MIT", False]
    header = "# " + full["Apache-2.0", False].strip().replace("\n", "\n# ") + "\n"
    code = "".join(f"def f{i}(x{i}):\n    return x{i} + {i}\n" for i in range(60))
    plain = [(f"p/{i}", f"some other text of the {i} kind is here and it goes on to the end of line {i}") for i in range(40)]
    files = [("m/terms", mit), ("m/x", "nothing here"), ("h/a.py", "import os\n" + header + code), ("h/x", "nothing here"), ("g/terms", full["GPL-3.0", True]), ("g/x", "nothing here"),
             ("b/terms", full["BSD-2-Clause", False]), ("q/notes", code + full["Apache-2.0", True] + code)]
    rows = scan(spark.createDataFrame(files + plain, "path string, text string")).collect()
    got = {r.path: (r.licence, r.source) for r in rows}
    assert {p: got[p] for p, _ in files} == {"m/terms": ("MIT", "own"), "m/x": ("MIT", "inherited"), "h/a.py": ("Apache-2.0", "own"), "h/x": (None, None), "g/terms": ("GPL-3.0", "own"),
                                             "g/x": ("GPL-3.0", "inherited"), "b/terms": ("BSD-2-Clause", "own"), "q/notes": ("Apache-2.0", "own")}
    assert all(got[p] == (None, None) for p, _ in plain)


def test_common_words_weigh_little_in_licence_statements(spark):
    common = [(f"c/{i}", f"It was word{i} for that.") for i in range(300)]
    said = [("a/1", "It was released under the MIT License."), ("a/2", "All rights reserved for that."), ("z/3", "Released rights quokka wombat numbat bilby.")]
    got = {r.path: r for r in scan(spark.createDataFrame(common + said, "path string, text string")).collect()}
    n, df = len(common + said), {"it": 301, "was": 301, "released": 2, "under": 1, "the": 1, "mit": 1, "license": 1}
    idf = {t: math.log((2 + n) / (1 + c)) for t, c in df.items()}
    want = math.sqrt(sum(idf[t] ** 2 for t in ("released", "under", "the", "mit", "license")) / sum(x * x for x in idf.values()))
    assert got["a/1"].licence == "MIT" and got["a/1"].cosine == pytest.approx(want) and want > 0.95
    assert got["a/2"].licence == "proprietary" and got["z/3"].licence is None


def test_pipeline_takes_odd_rows(spark, sd, odd_documents):
    docs = odd_documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sd)
        assert docs.columns == odd_documents.columns
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sd)
    assert {r.doc_id for r in last.collect()} == {None, 1, 6, 7, 8, 9} and "rate" in last.columns


def test_pipeline_of_no_rows_and_of_clashing_columns(spark, sd, no_documents, odd_documents):
    docs = no_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sd)
        assert docs.columns[: len(no_documents.columns)] == no_documents.columns and docs.count() == 0
    clashing = odd_documents.selectExpr("doc_id", "text", "lang", "source", "n_chars", "1 AS row", "2 AS rate", "3 AS fp", "4 AS n_tokens", "5 AS c0", "6 AS masked", "7 AS _spans", "8 AS component_id", "9 AS n_hit")
    docs = clashing
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sd)
        assert docs.columns[: len(clashing.columns)] == clashing.columns
    rows = docs.collect()
    assert {r.doc_id for r in rows} == {None, 1, 6, 7, 8, 9} and all((r.row, r.rate, r.fp, r.n_tokens, r.c0, r.masked, r.n_hit) == (1, 2, 3, 4, 5, 6, 9) for r in rows)
    assert all(r.mixed_rate >= 0 and r.mixed_n_tokens > 0 for r in rows)
