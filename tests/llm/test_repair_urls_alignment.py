"""Operators 11 to 13 against brute force, and on rows with nulls, empty and long texts, ties and repeats."""

import hashlib
import math
import random
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ladle.llm import conversation_repair as R
from ladle.llm import token_alignment as A
from ladle.llm import url_filter as U
from ladle.llm.queries import QUERIES

# --- 11 ---------------------------------------------------------------------------------------------------------------


def cheapest(rows):
    """(cost, edits) over whole strings: rows are (initial, must go, truncated)."""
    def inserted(best):
        grown = True
        while grown:
            grown = False
            for s, (cost, edits) in list(best.items()):
                t = R.ASSISTANT if s == R.USER else R.USER
                if (cost + 2, edits + "I") < best.get(t, (math.inf, "")):
                    best[t], grown = (cost + 2, edits + "I"), True
        return best
    best = inserted({R.EMPTY: (0, "")})
    for initial, must_go, cut in rows:
        now = {}
        for s, (cost, edits) in best.items():
            ways = [(s, cost + 3, edits + "D")]
            if not must_go:
                t = R.ASSISTANT if s == R.USER else R.USER
                same = initial == ("a" if s == R.USER else "u")
                ways.append((t, cost + cut + (0 if same else 2), edits + ("K" if same else "R")))
                if initial == "s" and s == R.EMPTY:
                    ways.append((R.SYSTEM, cost + cut, edits + "K"))
            for t, c, e in ways:
                now[t] = min(now.get(t, (math.inf, "")), (c, e))
        best = inserted(now)
    return min(best[s] for s in (R.EMPTY, R.ASSISTANT) if s in best)


def audited(rows):
    v, edits = R.Viterbi(), []
    for r in rows:
        edits += v.step(*r)
    cost, rest = v.finish()
    return cost, "".join(letter for letter, _ in edits + rest)


def test_edits_are_the_cheapest_and_least():
    rng = random.Random(1)
    for _ in range(3000):
        roles, gone = rng.choice(["ua", "sua", "s", "u", "axs", "uauas"]), rng.choice([0, 0.3])
        rows = [(rng.choice(roles), rng.random() < gone, rng.random() < 0.3) for _ in range(rng.randrange(14))]
        rows = [(i, g, c and not g) for i, g, c in rows]
        assert audited(rows) == cheapest(rows), rows


def test_survivors_coalesce_and_memory_stays_bounded():
    rng, v, most, settled = random.Random(2), R.Viterbi(), 0, 0
    for k in range(20_000):
        settled += len(v.step(rng.choice("uas"), k % 17 == 3, False))
        most = max(most, v.open)
    assert most < 100 and settled > 15_000
    v = R.Viterbi()
    for _ in range(5_000):  # only rows that have to go
        v.step("u", True, False)
    assert v.open < 10


def expected_conversations(rows):
    """The contract of op11 in plain Python; rows are (conv_id, turn, role, text)."""
    shown = lambda x: " " if x is None else str(x)
    found = {r[0]: [] for r in rows}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else shown(role)), ("" if kind == 1 else shown(text))
        text = "".join(c for c in text if c not in ".!?") if kind == 2 else text
        found[conv] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = {}
    for conv, kept in found.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, marks = set(), Counter(), []
        for _, role, text in kept:
            printed = text.strip(" \t\n\v\f\r")
            fault = "blank" if not printed else "duplicate" if (role, text) in seen else "truncated" if printed[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marks.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        cost, edits = cheapest(marks)
        turns = [t for t, _, _ in kept if t is not None]
        made, rest = [], iter(kept)
        odd = sum(e != "D" for e in edits) % 2
        for e in edits:
            _, role, text = next(rest) if e != "I" else (None, "", "")
            if e != "D":
                wanted = "user" if (len(made) + odd) % 2 == 0 else "assistant"
                made.append(f"{role if e == 'K' else wanted}:{text}")
        pairs = [a[0] + b[0] for a, b in zip(marks, marks[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256("\n".join(made).encode()).hexdigest())
    return out


def conversations(spark, rows):
    schema = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("live", T.StringType()), T.StructField("seen", T.StringType())])
    return spark.createDataFrame([(*r, "x", "x") for r in rows], schema).repartition(5)


def conversation_rows():
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(["Yes.", "no", "", " \n\t", None, "Why?  ", "é!", "x" * 60_000]))
            for c in [*range(60), None] for t in [*range(rng.randrange(9)), *([None, 3] if c and c % 7 == 0 else [])]]
    rows += rows[:20] + [(900, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(3000)]
    return rows + [(901, None, None, None), (902, 5, "user", "Hi."), (902, 9, "assistant", "Hello.")]


def test_conversations_against_brute_force(spark):
    rows = conversation_rows()
    got = {r["conv_id"]: tuple(r)[1:] for r in R.audit(R.damage(conversations(spark, rows))).collect()}
    assert got == expected_conversations(rows)


def test_dropped_and_missing_conversations(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    r = R.audit(R.damage(conversations(spark, [(gone, 0, "user", "Hi.")]))).collect()
    assert [tuple(x) for x in r] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert R.audit(R.damage(conversations(spark, []))).count() == 0


def test_repaired_rows_follow_the_audit(spark):
    rows = [(1, 0, "user", "One."), (1, 1, "user", "Two."), (1, 2, "assistant", "Three"), (2, 0, "assistant", ""), (3, 0, "system", "S."), (3, 1, "user", "Q?")]
    out = {(r["conv_id"], r["position"]): (r["role"], r["text"], r["edit"]) for r in R.repair(conversations(spark, rows)).collect()}
    assert out == {(1, 0): ("user", "One.", "K"), (1, 1): ("assistant", "", "I"), (1, 2): ("user", "Two.", "K"), (1, 3): ("assistant", "Three", "K"),
                   (3, 0): ("system", "S.", "K"), (3, 1): ("user", "Q?", "K"), (3, 2): ("assistant", "", "I")}


def test_texts_are_shuffled_once(spark):
    plan = R.audit(R.damage(conversations(spark, [(1, 0, "user", "Hi.")]).coalesce(1)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(conv_id") == 1 and "hashpartitioning(conv_id#" in plan and "live" not in plan.split("Exchange hashpartitioning(")[1].split(")")[0]


# --- 12 ---------------------------------------------------------------------------------------------------------------

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("host", T.StringType()),
                      T.StructField("gram", T.StringType()), T.StructField("n", T.StringType())])


def urls():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["the", "in", "er", "x9", "ß", "ü"]) for _ in range(3))
    made = [f"http{rng.choice(['', 's'])}://{rng.choice(['www.', ''])}{word()}.example.{rng.choice(['org', 'com', 'net'])}/{rng.choice(['en', 'fr', 'de', 'es'])}/"
            f"{rng.randrange(300)}{rng.choice(['', '?a=b', '#top'])}" for _ in range(400)]
    odd = [None, "", "no scheme", "://", "HTTP://A.ORG", "http://a.org/", "http://a.ORG/x?y://z", "http://example.org/es/1", "http://notexample.org/es/1",
           "http://x.com/FR/", "http://x.com/fr/", "http://x.com/de", "http://😀.net/😀", "http://l.net/" + "q" * 20_000, "http://org/", "http://b.org?x/"]
    return [*enumerate(made + odd), (None, made[0]), (3, made[3]), (3, made[3])]


def read_url(url):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    return U_lower(host), path


def U_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected_urls(pages):
    rows = []
    for page_id, url in pages:
        host, path = read_url(url)
        fits = [(r, v) for r, v in U.RULES if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith(r[r.find("/"):])]
        rule, ruled = max(fits, key=lambda f: len(f[0])) if fits else (None, None)
        held = int(hashlib.md5((url or "").encode()).hexdigest()[:4], 16) % U.CALIBRATION == 0
        text = "\2" * U.ORDER + U_lower(url or "") + "\3"
        rows.append((page_id, host, path, rule, ruled, held, [text[k:k + U.ORDER + 1] for k in range(len(text) - U.ORDER)]))
    counts = {"allow": Counter(), "block": Counter()}
    letters = {g[-1] for r in rows for g in r[6]}
    for r in rows:
        if r[4] and not r[5]:
            counts[r[4]].update(g[k:] for g in r[6] for k in range(U.ORDER + 1))
    sums = {v: (Counter(), Counter()) for v in counts}  # by context: places and distinct characters
    for v, c in counts.items():
        for s, n in c.items():
            sums[v][0][s[:-1], len(s)] += n
            sums[v][1][s[:-1], len(s)] += 1

    def chance(v, gram):
        p = (counts[v][gram[-1]] + 1) / (sums[v][0]["", 1] + len(letters))
        for k in range(2, U.ORDER + 2):
            s = gram[-k:]
            n, d = sums[v][0][s[:-1], k], sums[v][1][s[:-1], k]
            p = (counts[v][s] + d * p) / (n + d) if n else p
        return p
    terms = {g: round((math.log(chance("allow", g)) - math.log(chance("block", g))) * 1e6) for r in rows for g in set(r[6])}
    scores = [sum(terms[g] for g in r[6]) / (len(r[6]) * 1e6) for r in rows]
    bins = [max(-U.MAX_BIN, min(U.MAX_BIN, math.floor(s * U.BINS))) for s in scores]
    held = [(b, r[4]) for b, r in zip(bins, rows) if r[5] and r[4]]
    good, bad = sum(v == "allow" for _, v in held), sum(v == "block" for _, v in held)

    def margin(t):
        return sum(v == "allow" and b >= t for b, v in held) * bad - sum(v == "block" and b >= t for b, v in held) * good
    least = min({0, *(b for b, _ in held)}, key=lambda t: (-margin(t), abs(t), t))
    return Counter((r[0], r[1], r[2], r[3], r[4] or ("allow" if b >= least else "block"), round(s, 9)) for r, b, s in zip(rows, bins, scores))


def judged(df):
    return Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"], round(r["score"], 9)) for r in df.collect())


def test_urls_against_brute_force_and_beyond_the_broadcast_bound(spark):
    pages = spark.createDataFrame([(*p, "x", "x", "x") for p in urls()], PAGES).repartition(3)
    want = expected_urls(urls())
    assert judged(U.judge(pages)) == want
    assert judged(U.judge(pages, max_broadcast=10)) == want


def test_urls_without_examples_and_without_rows(spark):
    two = spark.createDataFrame([(1, "http://a.net/x", "x", "x", "x"), (2, None, "x", "x", "x")], PAGES)
    assert {(r["page_id"], r["rule"], r["verdict"]) for r in U.judge(two).collect()} == {(1, None, "allow"), (2, None, "allow")}
    assert U.judge(two.limit(0)).count() == 0
    kept = U.keep_allowed(two)
    assert kept.columns == two.columns and kept.count() == 2


# --- 13 ---------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = A.default_tokenizers()
    whole = Tokenizer.from_file(a)
    whole.encode_special_tokens = True
    return whole, sentencepiece.SentencePieceProcessor(model_file=b), A.byte_level(a).bytes.to_pylist(), A.sentence_pieces(b).bytes.to_pylist()


def expected_alignment(rows, tokenizers):
    """Each document by itself, tokenized as a whole; rows are (doc_id, text)."""
    whole, pieces, bytes_a, bytes_b = tokenizers
    out, linked = [], []
    for doc_id, text in rows:
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        target = (" " + (text or "")).encode()
        if b"".join(bytes_a[i] for i in a) != target or b"".join(bytes_b[i] for i in b) != target:
            a, b = [], []
        ends_a, ends_b = ([sum(len(known[i]) for i in ids[:k + 1]) for k in range(len(ids))] if len(ids) < 3000 else _ends(known, ids)
                          for known, ids in ((bytes_a, a), (bytes_b, b)))
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            x, y = i, j
            while i < len(a) and ends_a[i] <= end:
                i += 1
            while j < len(b) and ends_b[j] <= end:
                j += 1
            groups.append((a[x:i], b[y:j]))
        links, i, j = [], 0, 0
        while i < len(a) and j < len(b):
            links.append((a[i], b[j]))
            i, j = i + (ends_a[i] <= ends_b[j]), j + (ends_b[j] <= ends_a[i])
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), hashlib.sha256(text.encode()).hexdigest() if a else "", groups))
        linked.append(links)
    n = Counter(p for links in linked for p in links)
    highest = {}
    for (_, b), k in n.items():
        highest[b] = max(highest.get(b, 0), k)
    return [(*o[:5], sum(n[p] == highest[p[1]] for p in links), sum(n[p] for p in links), *o[5:]) for o, links in zip(out, linked)]


def _ends(known, ids):
    total, out = 0, []
    for i in ids:
        total += len(known[i])
        out.append(total)
    return out


ODD_TEXTS = ["a  b\n\tc  ", " lead", "x ", " ", "   ", "\n", "tab\t x\u00a0 y\u2003 z", "é à ß\u0085 q", "▁x ▁ y", "a▁", "<s> </s> <unk> <0x41>", "<|endoftext|>x",
             "😀 👩‍👩‍👧 x", "don't I'll  we've", "nul\0byte x", "\u3000 a", "ﬁ ½ Å", "a\r\n b", "12 345,678.9", "x" * 3000 + " y", "\ufeff bom", "a\u200b b"]


def test_alignment_against_brute_force(spark, edge_docs, tokenizers, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in edge_docs.collect()] + [(2000 + k, t) for k, t in enumerate(ODD_TEXTS)]
    docs = edge_docs.unionByName(spark.createDataFrame([(2000 + k, t) for k, t in enumerate(ODD_TEXTS)], "doc_id bigint, text string"), allowMissingColumns=True)
    got = A.align(docs).collect()
    want = expected_alignment(rows, tokenizers)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(tuple(r[c] for c in names) for r in got) == Counter(o[:8] for o in want)
    assert any(o[1] == 0 and t for o, (_, t) in zip(want, rows))  # some texts do not come back byte for byte
    spans = Counter((r["doc_id"], str([(list(g["a"]), list(g["b"])) for g in r["groups"]])) for r in A.groups(docs).collect())
    assert spans == Counter((o[0], str([(list(x), list(y)) for x, y in o[8]])) for o in want)


def test_slices_of_any_size_give_the_same(docs001, monkeypatch):
    some = docs001.where("doc_id < 60")
    want = sorted(map(tuple, A.align(some).collect()))
    monkeypatch.setattr(A, "SLICE_BYTES", 5_000)
    assert sorted(map(tuple, A.align(some).collect())) == want


def test_units_encode_as_whole_texts(tokenizers):
    whole, pieces, _, _ = tokenizers
    aligner = A.Aligner(*A.default_tokenizers())
    for text in ODD_TEXTS:
        units, _ = A.cut_units(pa.array([text]))
        assert aligner.a.ids(units).flatten().to_pylist() == whole.encode(" " + text, add_special_tokens=False).ids
        assert aligner.b.ids(units).flatten().to_pylist() == pieces.encode(text)


def test_no_documents(no_docs):
    assert A.align(no_docs).count() == 0 and A.groups(no_docs).count() == 0


@pytest.mark.parametrize("key", ["op11_conversation_repair", "op12_url_filter", "op13_token_alignment"])
def test_registered_queries_read_whole_tables(spark, sf_dir, key):
    out = QUERIES[key][0](spark, sf_dir)
    name, of = {"op11": ("conversations", "conv_id"), "op12": ("pages", "page_id"), "op13": ("documents", "doc_id")}[key.split("_")[0]]
    ids = spark.read.parquet(f"{sf_dir}/{name}.parquet").select(of)
    ids = ids.distinct() if of == "conv_id" else ids
    assert out.select(of).exceptAll(ids).count() == 0 and ids.exceptAll(out.select(of)).count() == 0


def test_rule_ties_and_subdomains(spark):
    rules = [("a.org/x", "allow"), ("b.org", "block"), ("org/", "block")]
    d = spark.createDataFrame([("s.a.org", "/xy"), ("aa.org", "/xy"), ("b.org", ""), ("org", "/")], "host string, path string")
    rule, verdict = U.rule_of(F.col("host"), F.col("path"), rules)
    assert [tuple(r) for r in d.select(rule, verdict).collect()] == [("a.org/x", "allow"), ("org/", "block"), ("b.org", "block"), ("org/", "block")]
