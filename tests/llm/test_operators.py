"""Every operator against brute force on a small corpus, and on nulls, ties, repeats and empty tables."""

from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import brute
from tableload.llm import bpe, chunk_dedup, common, fingerprints, jaccard_join, license_scan, line_dedup, pfair_mix, quality_mcd, suffix_array, suffix_dedup, warc_audit
from tableload.llm.graph import components

RANKS, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def by_id(df, *cols):
    return {r["doc_id"]: tuple(r[c] for c in cols) for r in df.collect()}


# 1 fingerprints


def test_fingerprints_estimate_jaccard(docs, texts):
    got = by_id(fingerprints.edited_neighbours(docs), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    ids = sorted(texts, reverse=True)
    errors, by_text = [], {}
    for i, d in enumerate(ids):
        own, nxt = texts[d] or "", texts[ids[(i + 1) % len(ids)]] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + nxt[:half]
        n, digest, mark, edited_mark, near_edited, near_next = got[d]
        assert (n, digest) == (len(own), brute.sha(edited.encode()))
        assert by_text.setdefault(own, mark) == mark
        assert by_text.setdefault(edited, edited_mark) == edited_mark
        for estimate, other in ((near_edited, edited), (near_next, nxt)):
            errors.append(abs(estimate - brute.jaccard(brute.shingles(own), brute.shingles(other))))
    assert np.mean(errors) < 0.03 and max(errors) < 0.15


def test_fingerprints_odd_rows(empty, repeated):
    assert fingerprints.edited_neighbours(empty).count() == 0
    rows = fingerprints.edited_neighbours(repeated).collect()
    assert len(rows) == 8
    assert len({r["fingerprint"] for r in rows if r["doc_id"] == 1}) == 1


# 2 line dedup


def test_line_dedup(docs, texts):
    got = by_id(line_dedup.line_report(docs), "n_lines", "n_dropped", "kept_sha256")
    expected = brute.kept_lines(texts)
    assert got == {d: (n, k, brute.sha(t.encode())) for d, (n, k, t) in expected.items()}
    assert sum(k for _, k, _ in got.values()) > 0


def test_line_dedup_keeps_columns(docs, texts):
    left = line_dedup.dedup_lines(docs)
    assert left.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in left.collect()} == {d: t for d, (_, _, t) in brute.kept_lines(texts).items()}


def test_line_runs_compact(spark):
    lines = [f"a line long enough to count {i % 40}" for i in range(400)]
    rows = [(i, line) for i, line in enumerate(lines)]
    runs = line_dedup.index_lines(line_dedup.hashed_lines(spark.createDataFrame(rows, "doc_id long, text string")), batches=8)
    assert len(runs.paths()) == 1 and len(runs.levels) == 4  # 8 batches, fan-out 2
    assert {(r["last"]) for r in runs.settled().collect()} == set(range(360, 400))


def test_line_dedup_odd_rows(empty, repeated):
    assert line_dedup.line_report(empty).count() == 0
    rows = line_dedup.line_report(repeated).collect()
    assert len(rows) == 8 and all(r["n_dropped"] == 0 for r in rows)  # documents 1 and 2 only


# 3 suffix arrays


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(3)
    for _ in range(150):
        t = np.r_[rng.integers(1, rng.integers(2, 5), rng.integers(1, 50)), 0].astype(np.uint16)
        order = suffix_array.suffix_array(t)
        assert order.tolist() == sorted(range(len(t)), key=lambda i: t[i:].tolist())
        _, lcp = suffix_array.permuted_lcp(t, order, np.array([0]), 100)
        for a, b in zip(order[1:], order):
            same = 0
            while max(a, b) + same < len(t) and t[a + same] == t[b + same]:
                same += 1
            assert lcp[a] == same


@pytest.mark.parametrize("contexts", [suffix_dedup.SHARD_CONTEXTS, 8, 2])
def test_suffix_dedup(docs, texts, contexts, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", contexts)  # fewer: frequent anchors go by class, then by window digest
    got = by_id(suffix_dedup.repeat_report(docs), "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == {d: (*r[:3], brute.sha(r[3])) for d, r in brute.without_repeats(texts).items()}


def test_suffix_dedup_anchor_without_repeated_window(spark):
    """Texts that share an anchor's bytes but no whole window: their shard finds nothing."""
    rng = np.random.default_rng(6)
    own = ["".join(rng.choice(list("abcdefghijkl"), 300)) for _ in range(2)]
    shared = "".join(rng.choice(list("mnopqrst"), 150))
    rows = [(i, t[:150] + shared + t[150:]) for i, t in enumerate(own)]
    got = suffix_dedup.repeat_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got] == [(450, 0, 0)] * 2


def test_suffix_dedup_looks_for_anchors_once(docs, monkeypatch):
    plans, save = {}, suffix_dedup.save
    monkeypatch.setattr(suffix_dedup, "save", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or save(df, name))
    suffix_dedup.repeated_windows(docs.where("doc_id is not null and text is not null"))
    assert plans["anchor-found"].count("MapInPandas") == 1 and not any("Join" in plans[n] for n in ("anchor-found", "anchor-mixed"))


def test_suffix_dedup_shuffles_no_text_for_frequent_anchors(docs, monkeypatch):
    plans, save = {}, suffix_dedup.save
    monkeypatch.setattr(suffix_dedup, "SHARD_CONTEXTS", 8)
    monkeypatch.setattr(suffix_dedup, "save", lambda df, name: plans.update({name: df._jdf.queryExecution().optimizedPlan().toString()}) or save(df, name))
    suffix_dedup.repeated_windows(docs.where("doc_id is not null and text is not null"))
    assert "Join LeftSemi" in plans["anchor-classes"] and "Join LeftOuter" not in plans["anchor-classes"]


def test_suffix_dedup_frequent_pieces(docs, texts):
    """The contexts of some anchors are those that the anchors' own places give, whatever texts lie beside theirs."""
    body = docs.where("text is not null")
    every = suffix_dedup.anchors(body.select("doc_id", "text")).collect()
    wanted = {r["a"] for r in sorted(every, key=lambda r: r["c"])[::9]}
    got = suffix_dedup.frequent_pieces(body, np.array(sorted(wanted), dtype=np.int64).view(np.uint64)).collect()
    expected = []
    for r in every:
        data, lo = texts[r["doc_id"]].encode(), max(0, r["pos"] - suffix_dedup.LEFT)
        expected.append((r["a"], r["doc_id"], r["pos"], r["pos"] - lo, data[lo : r["pos"] + suffix_dedup.RIGHT]))
    assert Counter((*r[:4], bytes(r[4])) for r in got) == Counter(e for e in expected if e[0] in wanted)


def test_suffix_dedup_odd_rows(empty, repeated):
    assert suffix_dedup.repeat_report(empty).count() == 0
    rows = suffix_dedup.repeat_report(repeated).collect()
    assert len(rows) == 8
    # every row is a document: document 1 (three rows), 2 and the one without a doc_id hold one text
    assert Counter(r["n_removed"] > 0 for r in rows) == {True: 5, False: 3}


def test_suffix_dedup_repeated_and_null_ids(spark):
    rng = np.random.default_rng(16)

    def some(n):
        return "".join(rng.choice(list("abcdefghij"), n))

    passage = some(400)
    rows = [(7, some(500) + passage), (7, "short " + some(60)), (8, some(300)), (None, passage + some(90)), (None, some(700) + passage + some(40)), (7, some(20) + passage), (9, passage[:150])]
    rows += [(5, some(250))] * 2 + [(6, "x" * 199)] * 2 + [(None, None), (None, "")]
    got = suffix_dedup.repeat_report(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    want = brute.without_repeats({i: t for i, (_, t) in enumerate(rows)})
    expected = Counter((d, *want[i][:3], brute.sha(want[i][3])) for i, (d, _) in enumerate(rows))
    assert Counter(tuple(r) for r in got) == expected
    # doc_ids at the end of their range leave no numbers beyond
    edge = [(2**63 - 1, passage), (2**63 - 1, passage + "y"), (3, "z" + passage)]
    assert [r["n_removed"] for r in suffix_dedup.repeat_report(spark.createDataFrame(edge, "doc_id long, text string")).collect()] == [400] * 3


# 4 byte-level BPE


def test_bpe(docs, texts):
    enc = bpe.encoding(RANKS, PATTERN)
    got = by_id(bpe.encode_documents(docs, RANKS, PATTERN), "n_tokens", "ids", "ids_sha256", "decoded_sha256")
    for d, t in texts.items():
        ids = enc.encode_ordinary(t or "")
        assert got[d] == (len(ids), ids, brute.sha(np.array(ids, dtype="<u4").tobytes()), brute.sha((t or "").encode()))


def test_bpe_safe_pieces():
    enc = bpe.encoding(RANKS, PATTERN)
    text = "I've  don't  12ab,3日本語。テスト  \n\n x'll  été'S!! 5's\x1c" * 300 + "y" * 2000
    for size in (1, 7, 100, 5000):
        pieces = list(bpe.safe_pieces(text, size))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in enc.encode_ordinary(p)] == enc.encode_ordinary(text)


def test_bpe_decodes_and_odd_rows(docs, empty, repeated, texts):
    tokens = bpe.encode_documents(docs, RANKS, PATTERN)
    back = {r["doc_id"]: bytes(r["decoded"]) for r in bpe.decode_documents(tokens, RANKS, PATTERN).collect()}
    assert back == {d: (t or "").encode() for d, t in texts.items()}
    assert bpe.encode_documents(empty, RANKS, PATTERN).count() == 0
    assert bpe.encode_documents(repeated, RANKS, PATTERN).count() == 8


# 5 Merkle audit


def replica(spark, rows):
    return warc_audit.record_digests(spark.createDataFrame(rows, "file string, no long, body binary"), "file", "no", "body")


def test_merkle_audit_finds_damage(spark):
    rows = [(f"f{i % 5}", i, bytes([i % 251]) * (3000 + i)) for i in range(300)]
    bad = [r if r[1] not in (17, 123) else (r[0], r[1], b"#" + r[2][1:]) for r in rows if r[1] not in (298, 299)]
    found = warc_audit.audit(replica(spark, rows), replica(spark, bad)).collect()
    assert {(r["key"], r["status"]) for r in found} == {(17, "corrupt"), (123, "corrupt"), (298, "lost"), (299, "lost")}
    back = warc_audit.audit(replica(spark, bad), replica(spark, rows)).collect()
    assert {(r["key"], r["status"]) for r in back} == {(17, "corrupt"), (123, "corrupt"), (298, "extra"), (299, "extra")}


def damage(spark, rows, bad):
    got = warc_audit.audit(replica(spark, rows), replica(spark, bad)).collect()
    return sorted((str(r["file"]), r["key"] if r["key"] is not None else -1, r["status"]) for r in got)


def test_merkle_audit_mid_file(spark):
    """A loss, a longer record and an insertion in mid-file move all after them; what only moved is sound."""
    rows = [("f", i, bytes([i % 251]) * (9000 + 37 * i)) for i in range(60)]
    assert damage(spark, rows, [r for r in rows if r[1] != 4]) == [("f", 4, "lost")]
    assert damage(spark, rows, [r if r[1] != 20 else (*r[:2], r[2] + b"++") for r in rows]) == [("f", 20, "corrupt")]
    assert damage(spark, rows, [*rows, ("f", 100, b"new")]) == [("f", 100, "extra")]
    bad = [r if r[1] != 33 else (*r[:2], b"~" + r[2][1:]) for r in rows if r[1] not in (4, 40)]
    assert damage(spark, rows, bad) == [("f", 4, "lost"), ("f", 33, "corrupt"), ("f", 40, "lost")]
    at = {r["key"]: r["offset"] for r in warc_audit.audit(replica(spark, rows), replica(spark, bad)).collect()}
    assert at == {k: sum(len(r[2]) for r in rows[:k]) for k in (4, 33, 40)}


def test_merkle_audit_null_files_and_keys(spark):
    rows = [(None, i, b"%d" % i * 9) for i in range(5)] + [("a", None, b"x"), ("a", None, b"y"), ("a", 9, b"z")]
    assert damage(spark, rows, [r if r[1] != 3 else (None, 3, b"~") for r in rows]) == [("None", 3, "corrupt")]
    assert damage(spark, rows, rows[:5]) == [("a", -1, "lost"), ("a", -1, "lost"), ("a", 9, "lost")]
    assert damage(spark, rows, [r if r[2] != b"x" else ("a", None, b"w") for r in rows]) == [("a", -1, "extra"), ("a", -1, "lost")]


def test_merkle_audit_empty_and_repeated_records(spark):
    # empty records share an offset
    rows = [("e", 1, b""), ("e", 2, b""), ("e", 3, None), ("e", 4, b"end")]
    assert damage(spark, rows, [r if r[1] != 2 else ("e", 2, b"!") for r in rows]) == [("e", 2, "corrupt")]
    assert damage(spark, rows, [r for r in rows if r[1] != 3]) == [("e", 3, "lost")]
    # rows that repeat a key are a multiset
    rows = [("r", 7, b"same")] * 5 + [("r", 7, b"other"), ("r", 8, b"tail")]
    assert damage(spark, rows, rows[2:]) == [("r", 7, "lost")] * 2
    assert damage(spark, rows, rows[1:] + [("r", 7, b"new")]) == [("r", 7, "corrupt")]
    assert damage(spark, rows, rows[2:] + [("r", 7, b"new")]) == [("r", 7, "extra"), ("r", 7, "lost"), ("r", 7, "lost")]
    offsets = sorted(r["offset"] for r in warc_audit.audit(replica(spark, rows), replica(spark, rows[2:])).collect())
    alike = 0 if brute.sha(b"same") < brute.sha(b"other") else 5
    assert offsets == [alike + 12, alike + 16]


def test_merkle_audit_odd_rows(spark):
    rows = [("a", 1, None), ("a", 2, b""), ("b", None, b"x"), (None, 4, b"y")]
    one = replica(spark, rows)
    assert warc_audit.audit(one, one).count() == 0
    none = replica(spark, [])
    assert warc_audit.audit(none, none).count() == 0
    assert sorted(r["status"] for r in warc_audit.audit(one, none).collect()) == ["lost"] * 4
    assert sorted(r["status"] for r in warc_audit.audit(none, one).collect()) == ["extra"] * 4


def test_merkle_offsets_by_block(spark, monkeypatch):
    """Offsets through blocks of keys are those of a plain running sum; a frequent key and null are split by digest."""
    monkeypatch.setattr(common, "KEY_BLOCK_ROWS", 16)
    rng = np.random.default_rng(5)
    rows = [(["f", "g", None][i % 3], None if i % 7 == 0 else 50 if i % 3 == 0 else int(rng.integers(0, 200)), bytes(rng.integers(0, 9, rng.integers(0, 40)).tolist())) for i in range(900)]
    got = replica(spark, rows).collect()
    for file in ("f", "g", None):
        order = sorted([r for r in got if r["file"] == file], key=lambda r: (r["key"] is not None, r["key"] or 0, r["digest"]))
        at = pos = 0
        for r in order:
            assert (r["offset"], r["pos"]) == (at, pos)
            at, pos = at + r["length"] * r["copies"], pos + max(1, r["length"]) * r["copies"]
        assert sum(r["copies"] for r in order) == 300


# 6 quality rules


def test_quality_counts(docs, texts):
    got = by_id(quality_mcd.quality_verdicts(docs), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    for d, t in texts.items():
        c = brute.counts(t)
        failed = c[0] < 50 or 100 * c[4] > 50 * c[0]
        assert got[d][:6] == (*c, failed)
        assert not (failed and got[d][6])


def test_quality_rejects_outliers_only(spark):
    rng = np.random.default_rng(8)
    clean = [" ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(80, 300))) for _ in range(300)]
    junk = [t.replace(" ", "&&& ") for t in clean[:15]] + [t.upper() + "!!" for t in clean[15:30]]
    rows = [(i, t, "en", "a") for i, t in enumerate(clean + junk)]
    got = by_id(quality_mcd.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")), "kept")
    assert all(got[i][0] for i in range(300)) and not any(got[i][0] for i in range(300, 330))


def test_quality_rejects_repeats_alone(spark):
    """30 to 45% repeated windows, or repeated lines, in a group that has none, nothing else being unusual."""
    rng = np.random.default_rng(8)

    def some(n: int) -> list[str]:
        return ["".join(rng.choice(list("abcdefgh"), rng.integers(4, 9))) for _ in range(n)]

    clean = [" ".join(some(rng.integers(80, 300))) for _ in range(300)]
    windows, lines = [], []
    for k in range(30):
        w = some(rng.integers(150, 400))
        m = int(len(w) * (0.3 + 0.005 * k) / 2)
        windows.append(" ".join([*w[: len(w) - m], *w[:m]]))
        single = [" ".join(some(2)) for _ in range(100)]
        lines.append("\n".join([*single, *[single[0]] * 60]))
    rows = [(i, t, "en", "a") for i, t in enumerate(clean + windows)]
    got = by_id(quality_mcd.quality_verdicts(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")), "kept")
    assert all(got[i][0] for i in range(300)) and not any(got[i][0] for i in range(300, 330))
    x2 = [r["x2"] for r in quality_mcd.with_vector(quality_mcd.text_statistics(spark.createDataFrame([(t,) for t in [*clean, *lines]], "text string"))).collect()]
    assert min((x - max(x2[:300])) ** 2 for x in x2[300:]) / quality_mcd.FLOOR[2] ** 2 > quality_mcd.CUT


def test_quality_whitening_is_mahalanobis(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 5))
    rows = spark.createDataFrame([(i, "g", *map(float, r)) for i, r in enumerate(x)], "`__row` long, g string, x0 double, x1 double, x2 double, x3 double, x4 double")
    fit = quality_mcd.with_whitening(rows.groupBy("g").agg(*quality_mcd._moments()).withColumn("start", F.lit(0)))
    got = [r[0] for r in rows.join(fit, "g").orderBy("__row").select(quality_mcd.distance2()).collect()]
    cov = np.cov(x.T, bias=True) + np.diag(np.square(quality_mcd.FLOOR))
    centred = x - x.mean(0)
    assert np.allclose(got, np.einsum("ij,jk,ik->i", centred, np.linalg.inv(cov), centred))


def test_quality_odd_rows(empty, repeated):
    assert quality_mcd.quality_verdicts(empty).count() == 0
    assert quality_mcd.quality_verdicts(repeated).count() == 8
    kept = quality_mcd.keep_quality(repeated)
    assert kept.columns == repeated.columns and kept.count() == 5


# 7 licence scans


def test_license_scan(spark, corpus):
    notes = {2000: "Licensed under the Apache License, Version 2.0.", 2001: "Released under the MIT License.", 2002: "This work is licensed under the GNU General Public License, version 3."}
    rows = [(r[0], r[1]) for r in corpus] + [(d, "some words here\n" + n + "\nmore words") for d, n in notes.items()]
    got = license_scan.license_findings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in got if r["confirmed"]} == {(2000, 1, "apache"), (2001, 1, "mit"), (2002, 1, "gpl")}
    assert {r["doc_id"] for r in got} == set(notes)


def test_license_scan_wrapped_notices(spark, corpus):
    """Every family's longest notice, wrapped as a comment; one inside a line of 5,000 words; held against a template search."""
    import re
    import textwrap

    rng = np.random.default_rng(7)
    words = ["".join(rng.choice(list("abcdefghijkl"), rng.integers(2, 8))) for _ in range(3000)]

    def some(n):
        return " ".join(rng.choice(words, n))

    marks = ["# ", "// ", " * ", "-- "]
    texts, where = {}, {}
    for i, family in enumerate(license_scan.FAMILIES):
        notice = max(license_scan.NOTICES[family], key=len)
        comment = textwrap.wrap(notice, 68, initial_indent=marks[i % 4], subsequent_indent=marks[i % 4])
        before = textwrap.wrap(some(30 * i), 70)
        texts[5000 + i] = "\n".join([*before, "", *comment, "", *textwrap.wrap(some(150), 70)])
        where[5000 + i] = (len(before) + 1, family)
    long = max(license_scan.NOTICES["mit"], key=len)
    texts[5100], where[5100] = some(2500) + " " + long + " " + some(2500), (0, "mit")
    rows = [(r[0], r[1]) for r in corpus] + [(900, some(4000))] + list(texts.items())
    got = license_scan.license_findings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["paragraph"], r["family"]) for r in got if r["confirmed"]} == {(d, *w) for d, w in where.items()}
    assert len([r for r in got if r["confirmed"]]) == 13
    # the share of the notice's three-word n-grams, by brute force over the whole text
    for r in got:
        held = set(license_scan._grams(re.sub(r"[^a-z0-9]+", " ", (texts.get(r["doc_id"]) or "").lower())))
        shares = [len(held & set(license_scan._grams(t))) / max(1, len(license_scan._grams(t))) for t in license_scan.NOTICES.get(r["family"], [])]
        assert r["likeness"] <= max(shares, default=0) + 1e-9 and (not r["confirmed"] or max(shares) == 1)


def test_license_scan_trains_on_all_windows(spark):
    """Every different window of the corpus is trained on or calibrates, those of a repeated text once."""
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefghijkl"), rng.integers(2, 8))) for _ in range(500)] + ["the", "of", "and", "license"]
    texts = [list(rng.choice(words, 4000)) for _ in range(40)]
    texts += [texts[0], texts[1][:960]]
    size, step = license_scan.WINDOW, license_scan.STRIDE
    different = {tuple(t[i : i + size]) for t in texts for i in range(0, max(len(t) - (size - step), 1), step)}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    trained = license_scan.train(docs)[0].summary.predictions.where(f"label = {license_scan.NONE}").count() - 1
    assert len(different) > 3000 and 0.45 * len(different) < trained < 0.55 * len(different)
    rows = license_scan.none_rows(license_scan.windows(docs))
    assert (rows.count(), rows.where("not held").count()) == (len(different), trained)


def test_license_scan_features_are_the_used_hash_columns(spark):
    """The vectors are those that hashing gives, without the columns that no notice's n-gram has."""
    from pyspark.ml.feature import HashingTF

    notices = [t for f in license_scan.FAMILIES for t in license_scan.NOTICES[f]]
    rows = license_scan.paragraphs(spark.createDataFrame([*enumerate(notices), (100, "words of none 2 of this program, a clause license under the"), (101, "zz")], "doc_id long, text string"))
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=license_scan.FEATURES, binary=True)
    known = {g for n in (1, 2) for g in license_scan.NOTICE_GRAMS[n]}
    used = sorted({hashed.indexOf(g) for g in known})
    got = {(r["doc_id"], r["window"]): (r["words"], r["features"]) for r in license_scan.with_features(rows).collect()}
    assert len(got) == rows.count() >= 26
    for words, vector in got.values():
        grams = {" ".join(words[i : i + n]) for n in (1, 2) for i in range(len(words) - n + 1)} & known
        assert vector.size == len(used) < 400
        assert {used[i]: v for i, v in zip(vector.indices, vector.values, strict=True)} == {hashed.indexOf(g): 1.0 for g in grams}


def test_license_scan_odd_rows(empty, repeated):
    assert license_scan.license_findings(empty).count() == 0
    assert license_scan.license_findings(repeated).count() == 0


# 8 content-defined chunks


def test_chunks_resist_shifts():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 6000).astype(np.uint8)
    moved = np.r_[rng.integers(97, 123, 37).astype(np.uint8), data]
    a = {bytes(data[s:e]) for s, e in zip(np.r_[0, chunk_dedup.chunk_ends(data)[:-1]], chunk_dedup.chunk_ends(data))}
    b = {bytes(moved[s:e]) for s, e in zip(np.r_[0, chunk_dedup.chunk_ends(moved)[:-1]], chunk_dedup.chunk_ends(moved))}
    assert len(a & b) > 0.9 * len(a)
    h = chunk_dedup.gear_hash(data)
    slow = 0
    for i, byte in enumerate(data.tolist()):
        slow = ((slow << 1) + int(chunk_dedup._GEAR[byte])) % 2**64
        assert slow == int(h[i]) or i > 300


def test_chunk_dedup(docs, texts):
    spans = chunk_dedup.repeated_spans(docs).collect()
    caught = {r["doc_id"] for r in spans}
    held = Counter()
    for t in texts.values():
        w = (t or "").split()
        held.update({tuple(w[i : i + 51]) for i in range(len(w) - 50)})  # a set: repeats within one document do not count
    for d, t in texts.items():
        w = (t or "").split()
        if any(held[tuple(w[i : i + 51])] > 1 for i in range(len(w) - 50)):
            assert d in caught, t[:80]
    everywhere = Counter()
    for t in texts.values():
        b = (t or "").encode()
        everywhere.update({b[i : i + 64] for i in range(len(b) - 63)})
    for r in spans:  # a span's bytes are held by another document
        b = texts[r["doc_id"]].encode()[r["span_start"] : r["span_end"]]
        assert len(b) >= chunk_dedup.MIN_RUN and everywhere[b[:64]] > 1 or len(b) < 64


def test_chunk_dedup_makes_sequences_once(docs):
    plan = chunk_dedup.repeated_sequences(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInPandas") == 1 and "Join" not in plan


def test_chunk_dedup_catches_short_passages(spark):
    """Passages of 51 words of 1 to 5 letters, each in two documents."""
    rng = np.random.default_rng(51)

    def some(n: int) -> str:
        return " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(1, 6))) for _ in range(n))

    rows = []
    for i in range(100):
        passage = some(51)
        rows += [(2 * i + k, f"{some(60 + k)} {passage} {some(60)}") for k in range(2)]
    got = {r["doc_id"] for r in chunk_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == set(range(200))


def test_chunk_spans_are_held_as_a_whole(spark):
    """Chunks that are found elsewhere one by one are no repeated span; the same chunks as one run are."""
    rng = np.random.default_rng(11)
    data = bytes(rng.integers(97, 123, 2000).astype(np.uint8))
    edges = np.r_[0, chunk_dedup.chunk_ends(np.frombuffer(data, dtype=np.uint8))].tolist()
    rows = [(0, data.decode())]
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):  # each chunk in a text of its own, among other bytes
        around = [bytes(rng.integers(65, 91, 200).astype(np.uint8)) for _ in range(2)]
        before = max(0, lo - 64)
        rows.append((i + 1, (around[0] + data[before : min(hi + 20, before + chunk_dedup.MIN_RUN - 1)] + around[1]).decode()))
    single = spark.createDataFrame(rows, "doc_id long, text string")
    assert chunk_dedup.repeated_spans(single).count() == 0
    whole = spark.createDataFrame([*rows, (9999, "A" * 70 + data[500:1500].decode())], "doc_id long, text string")
    spans = {r["doc_id"]: (r["span_start"], r["span_end"], r["n_removed"]) for r in chunk_dedup.repeated_spans(whole).collect()}
    assert set(spans) == {0, 9999}
    start, end, gone = spans[9999]
    assert rows[0][1][spans[0][0] : spans[0][1]] == ("A" * 70 + data[500:1500].decode())[start:end]
    assert gone == end - start > 800 and spans[0][2] == 0


def test_chunk_dedup_cuts_text(docs, texts, empty, repeated):
    left = chunk_dedup.dedup_substrings(docs)
    assert left.columns == docs.columns
    size = {r["doc_id"]: len(r["text"]) for r in left.collect()}
    assert sum(size.values()) < sum(len(t or "") for t in texts.values())
    assert all(size[d] <= len(t or "") for d, t in texts.items())
    assert chunk_dedup.repeated_spans(empty).count() == 0
    assert {r["doc_id"] for r in chunk_dedup.repeated_spans(repeated).collect()} == {1, 2}


# 9 n-gram Jaccard join


@pytest.mark.parametrize("short", [jaccard_join.SHORT_LIST, 3])
def test_jaccard_join(docs, texts, short, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)  # 3: most lists are long
    got = by_id(jaccard_join.near_duplicates(docs), "n_shingles", "component_id")
    assert got == brute.components(texts)


def test_jaccard_search_without_star(docs, texts, monkeypatch):
    """Step 5 alone finds every link: the leaders of step 4 only save work."""
    star = jaccard_join.star_links
    monkeypatch.setattr(jaccard_join, "star_links", lambda ranked: star(ranked).limit(0))
    for short in (64, 2):
        monkeypatch.setattr(jaccard_join, "SHORT_LIST", short)
        assert by_id(jaccard_join.near_duplicates(docs), "n_shingles", "component_id") == brute.components(texts)


def test_jaccard_joins_short_copies(spark):
    """A 7-word text and the same text plus one word: 3 of 4 shingles are shared, so they link."""
    rows = []
    for i in range(40):
        w = [f"w{i}x{k}" for k in range(8)]
        rows += [(2 * i, " ".join(w[:7])), (2 * i + 1, " ".join(w))]
    got = by_id(jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")), "n_shingles", "component_id")
    assert got == {d: (3 + d % 2, d - d % 2) for d in range(80)}


def test_jaccard_need_holds_for_every_pair_of_sizes():
    for a in range(1, 400):
        for b in range(a, 100 * a // 75 + 1):
            o = -(-75 * (a + b) // 175)
            shown = min(jaccard_join.hash_prefix(a) - (a - o), jaccard_join.hash_prefix(b) - (b - o))
            assert 1 <= max(jaccard_join.hash_need(a), jaccard_join.hash_need(b)) <= shown


def test_jaccard_odd_rows(empty, repeated):
    assert jaccard_join.near_duplicates(empty).count() == 0
    rows = jaccard_join.near_duplicates(repeated).collect()
    assert len(rows) == 8
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(1, 1), (2, 1), (None, None), (4, 4), (5, 5)}
    assert sorted(r["doc_id"] or 0 for r in jaccard_join.keep_one_each(repeated).collect()) == [0, 0, 1, 1, 1, 4, 5]


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (5, 5)], "a long, b long")
    got = {r["doc_id"]: r["label"] for r in components(edges).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, 100: 100, 101: 100, 102: 100}


# 10 Pfair mix


def test_mix_follows_edf_and_stays_within_a_block(spark):
    rows = [(i, "abc"[min(i % 7, 2)]) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    parts = {r["source"]: r["parts"] for r in pfair_mix.source_parts(docs, total=32).collect()}
    names = sorted(parts)
    order = brute.edf([parts[s] for s in names])
    got = {r["at"]: r["source"] for r in pfair_mix.period(pfair_mix.source_parts(docs, total=32)).collect()}
    assert [got[t] for t in range(len(order))] == [names[i] for i in order]
    had = Counter()
    for t, s in sorted(got.items()):
        had[s] += 1
        assert all(abs(had[n] - (t + 1) * parts[n] / len(order)) < 1 for n in names)


def test_mix_of_many_sources(spark):
    """1,001 sources, one with a third of all rows: its share of the slots is its weight, and the small ones take little."""
    sizes = spark.range(1001).select(F.concat(F.lit("s"), "id").alias("source"), F.when(F.col("id") == 0, 500).otherwise(1).alias("n"))
    docs = sizes.select("source", F.explode(F.sequence(F.lit(1), F.col("n")))).select("source", F.monotonically_increasing_id().alias("doc_id"))
    parts = {r["source"]: r["parts"] for r in pfair_mix.source_parts(docs).collect()}
    total, true = sum(parts.values()), 500**0.7 / (500**0.7 + 1000)
    assert len(parts) == 1001 and abs(parts["s0"] / total - true) < 0.005 * true
    # over one period its blocks are within one block of the true weight
    order = sorted((r["at"], r["source"]) for r in pfair_mix.period(spark.createDataFrame([("big", parts["s0"]), ("rest", total - parts["s0"])], "source string, parts long")).collect())
    had = 0
    for t, (_, source) in enumerate(order):
        had += source == "big"
        assert abs(had - (t + 1) * true) < 1.5


def test_mix_places_every_document_once(docs, texts, empty, repeated):
    rows = pfair_mix.mix_schedule(docs, block_docs=4).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    assert len({(r["slot"], r["place"]) for r in rows}) == len(rows)
    by_source = {}
    for r in sorted(rows, key=lambda r: (r["slot"], r["place"])):
        by_source.setdefault(r["source"], []).append(r["doc_id"])
    assert all(ids == sorted(ids) for ids in by_source.values())
    mixed = pfair_mix.mix_documents(docs, block_docs=4)
    assert mixed.columns == docs.columns
    assert [r["doc_id"] for r in mixed.collect()] == [r["doc_id"] for r in sorted(rows, key=lambda r: (r["slot"], r["place"]))]
    assert pfair_mix.mix_schedule(empty).count() == 0
    assert pfair_mix.mix_schedule(repeated).count() == 8
