"""License scan, quality rules, mixing and sharding against plain-Python versions."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from ladle.llm import license_scan as LS
from ladle.llm import mixing as MX
from ladle.llm import quality_rules as QR
from ladle.llm import sharding as SH

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_license(text):
    lower = (text or "").translate(LOWER)
    w = re.findall(LS.SEPARATORS.replace("[", "[^"), lower)
    places = defaultdict(list)
    for phrase, label in LS.BASE_PHRASES:
        p = phrase.split()
        places[label] += [i for i in range(len(w)) if w[i:i + len(p)] == p]
    every = [i for at in places.values() for i in at]
    base = sorted(k for k, at in places.items() if at)
    labels, best, blocks = set(base), 0.0, 0
    sets, sizes = [set(t.split()) for _, t in LS.TEMPLATES], LS.classes(LS.TEMPLATES)
    for size in LS.WINDOWS:
        for k in range(0, len(w), size // 4):
            have = set(w[k:k + size])
            met = [i for i, t in enumerate(sets) if sizes[i] == size and len(have & t) >= LS.need(len(t), LS.THRESHOLD)]
            own = [i for i in met if not any(sets[i] < sets[j] for j in met)]
            labels |= {LS.TEMPLATES[i][0] for i in own}
            best = max([best, *(len(have & sets[i]) / len(sets[i]) for i in own)])
            blocks += bool(own)
    return (len(w), len(every), min(every, default=None), max(every, default=None), ",".join(base), ",".join(sorted(labels)),
            1.0 if every else best, blocks)


@pytest.mark.parametrize("which", ["edge_docs", "docs001"])
def test_license_scan_matches_brute_force(which, request):
    docs = request.getfixturevalue(which)
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], round(r["score"], 9), r["n_blocks"])
                  for r in LS.scan(docs).collect())
    want = Counter()
    for r in docs.collect():
        b = brute_license(r["text"])
        want[(r["doc_id"], *b[:6], round(b[6], 9), b[7])] += 1
    assert got == want
    assert any(k[2] for k in got)


NOTICES = {
    "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that": "bsd",
    "Permission to use, copy, modify, and/or distribute this software for\n any purpose with or without fee is hereby\n granted": "isc",
    "x " * 37 + "Permission is hereby granted, free of\n * charge, to any person obtaining a\n * copy of this software " + "y " * 50: "mit",
    "You may redistribute it and/or modify\nit under the terms of the GNU General Public License\nas published by the Free Software Foundation": "gpl",
    "licensed under the GNU Lesser General Public License": "lgpl",
    "It is licensed under the\nGNU Affero General Public License": "agpl",
    "Licensed under CC BY-NC 4.0": "cc-by,cc-by-nc",  # the base phrase stays
    "they released " + "more prose " * 90 + "under the sun " + "some words " * 90 + "a license " + "and so on " * 60 + "from mit": "",
    "wor\u212a released under the M\u0130T license": "",
}


def test_notices_across_lines_and_inside_others(spark):
    docs = spark.createDataFrame(list(enumerate(NOTICES)), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["labels"], r["n_blocks"]) for r in LS.scan(docs).collect()}
    for i, (text, want) in enumerate(NOTICES.items()):
        assert got[i] == (want, brute_license(text)[7]), text


def test_every_notice_fits_a_window_wherever_it_stands():
    for (_, text), size in zip(LS.TEMPLATES, LS.classes(LS.TEMPLATES)):
        n = len(text.split())
        assert all(any(k <= at and at + n <= k + size for k in range(0, at + 1, size // 4)) for at in range(200))


def brute_base(text):
    t = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = defaultdict(list)
    for i in range(len(w) - 2):
        grams[tuple(w[i:i + 3])].append(i)
    covered = {i + k for at in grams.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)


@pytest.mark.parametrize("which", ["edge_docs", "docs001"])
def test_rule_base_counts_match_brute_force(which, request):
    docs = request.getfixturevalue(which)
    rows = QR.judge(docs).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in rows)
    assert got == Counter((r["doc_id"], *brute_base(r["text"])) for r in docs.collect())
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_clashing_window_hashes_fall_back_to_words(spark, monkeypatch):
    monkeypatch.setattr(QR, "POSITION_BITS", 60)  # 4 bits of hash are left: most windows clash
    text = " ".join(["a b c d e f g h i j k l m n o p q r s t u v w x y z"] * 1 + ["a b c", "k l m n"])
    row = QR.with_base_counts(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row["n_repeat_words"] == brute_base(text)[4] == 14


def test_cascade_verdict_does_not_depend_on_order(edge_docs):
    counts = QR.with_base_counts(edge_docs)
    names = sorted(QR.RULES)
    one = counts.select("doc_id", "text", QR.cascade(names, QR.RULES).isNull().alias("ok"))
    two = counts.select("doc_id", "text", QR.cascade(names[::-1], QR.RULES).isNull().alias("ok"))
    assert Counter(map(tuple, one.collect())) == Counter(map(tuple, two.collect()))
    assert QR.order_rules([("a", 1.0, 0.1), ("b", 0.1, 0.1), ("c", 1.0, 0.0)]) == ["b", "a", "c"]


def inverse_poisson(u, mean):
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u and k < 1000:
        k += 1
        p = p * mean / k
        c += p
    return k


def test_poisson_inversion_matches_a_plain_loop(spark, docs001):
    rates = {None: 0.5, "src0": 0.2, "src1": 3.0, "src2": 100.0, "src3": 0.0}
    rate_df = spark.createDataFrame([(k, v) for k, v in rates.items()], "source string, rate double")
    got = Counter(r["doc_id"] for r in MX.replicate(docs001, rate_df).select("doc_id").collect())
    want = Counter()
    for r in docs001.collect():
        if r["source"] in rates:
            draws = max(1, math.ceil(rates[r["source"]] / MX.CHUNK))
            for j in range(1, draws + 1):
                u = int(hashlib.md5(f"42:{r['doc_id']}:{j}".encode()).hexdigest()[:13], 16) / 2 ** 52
                want[r["doc_id"]] += inverse_poisson(u, rates[r["source"]] / draws)
    assert got == +want


def test_rates_beyond_the_broadcast_bound_give_the_same_copies(spark, docs001, monkeypatch):
    want = Counter(r["doc_id"] for r in MX.mix(docs001).select("doc_id").collect())
    monkeypatch.setattr(MX, "MAX_BROADCAST_SOURCES", 0)
    weights = spark.createDataFrame([("src0", 3.0), ("src1", 1.0)], "source string, weight double")
    assert Counter(r["doc_id"] for r in MX.mix(docs001).select("doc_id").collect()) == want
    assert {r["source"] for r in MX.mix(docs001, weights).select("source").collect()} <= {"src0", "src1"}


def test_mix_reaches_the_target_and_handles_edges(edge_docs, no_docs, spark):
    out = MX.mix(edge_docs, total=4000)
    n = Counter(r["source"] for r in out.select("source").collect())
    rows = Counter(r["source"] for r in edge_docs.select("source").collect())
    weights = {k: math.sqrt(v) for k, v in rows.items()}
    for k, w in weights.items():
        want = 4000 * w / sum(weights.values())
        assert abs(n[k] - want) < 6 * math.sqrt(want)
    assert out.columns.count("copy") == 1
    assert MX.mix(no_docs).count() == 0
    assert Counter(map(str, MX.mix(edge_docs).collect())) == Counter(map(str, MX.mix(edge_docs.repartition(7)).collect()))


def test_sharding_is_lpt_and_keeps_groups_together(edge_docs, no_docs, texts001, docs001):
    for docs in (edge_docs, docs001):
        rows = SH.shard_documents(docs, shards=4).collect()
        src = docs.collect()
        assert Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in src) == Counter(
            (r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
        by_group, slots, loads = defaultdict(set), defaultdict(list), Counter()
        for r in rows:
            by_group[(r["size"], r["text_crc32"])].add(r["shard"])
            slots[r["shard"]].append(r["slot"])
            loads[r["shard"]] += r["size"]
        assert all(len(s) == 1 for s in by_group.values())
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        groups = Counter()
        for r in rows:
            groups[(r["size"], r["text_crc32"])] += r["size"]
        plain = Counter()
        for size in sorted(groups.values(), reverse=True):
            k = min(range(4), key=lambda s: (plain[s], s))
            plain[k] += size
        assert max(loads.values()) <= 1.05 * max(plain.values())
    assert SH.shard_documents(no_docs).count() == 0
    assert SH.lpt({"a": 5, "b": 4, "c": 3, "d": 3}, 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
