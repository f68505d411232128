"""Conversation repair, spelling variants and decontamination: brute force, edge rows, splits at every size, SQL."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from nimbria.llm import decontam, dialogue, spelling
from nimbria.llm.queries import op11_dialogue, op12_spelling, op13_decontam, oracle_sql
from tests.compare import connect, same

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CONVERSATION = "conv_id long, turn long, role string, text string"
DOCS = "doc_id long, text string"


@pytest.mark.parametrize("query", [op11_dialogue, op12_spelling, op13_decontam])
def test_queries_equal_sql(spark, sf, query):
    same(query(spark, sf), connect(sf), oracle_sql()[query.__name__])


# ---- conversation repair


def brute_repair(rows):
    """Cost, audit and lines of the cheapest edits of ordered (role, text) rows, over all ways to edit them."""
    seen, faults = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not shown else "d" if (role, text) in seen else "t" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    inserts = [(), ("u",), ("a",), ("u", "a"), ("a", "u")]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        for edits in itertools.product("KRD", repeat=len(rows)):
            if any(f in ("b", "d") and e != "D" for f, e in zip(faults, edits, strict=True)):
                continue
            for first in ("u", "a"):  # a rerole goes to the role that its place asks for: try both throughout
                cost, audit, initials, lines, flip = 0, "", "", [], first
                for i, gap in enumerate(gaps):
                    for role in gap:
                        cost, audit, initials = cost + 3, audit + "I", initials + role
                        lines.append(dialogue.ROLES[role] + ":")
                        flip = "a" if role == "u" else "u"
                    if i < len(rows):
                        role, text = rows[i]
                        audit += edits[i]
                        cost += {"K": 0, "R": 3, "D": 4}[edits[i]] + (3 if faults[i] == "t" and edits[i] != "D" else 0)
                        if edits[i] == "K":
                            initials += role[:1] or "?"
                            lines.append(f"{role}:{text}")
                            flip = {"u": "a", "a": "u"}.get(role[:1], "u")
                        elif edits[i] == "R":
                            initials += flip
                            lines.append(f"{dialogue.ROLES[flip]}:{text}")
                            flip = "a" if flip == "u" else "u"
                if re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best[:2]):
                    best = (cost, audit, lines)
    return faults, best


@pytest.mark.parametrize("bits", [12, 1])
def test_repair_equals_brute_force(spark, monkeypatch, bits):
    """Chunks of 4,096 rows and chunks of two give the same, least edits."""
    monkeypatch.setattr(dialogue, "CHUNK_BITS", bits)
    rng, rows = random.Random(11), []
    texts = ["One.", "Two", "", "Three!", " \t", "Four?\n", "Öl…"]
    for conv in range(60):
        rows += [(conv, t, rng.choice(["user", "assistant", "system", "tool", "assistant", "user"]), rng.choice(texts)) for t in range(rng.randrange(0, 4))]
    got = {r.conv_id: r for r in dialogue.digests(dialogue.repair(spark.createDataFrame(rows, CONVERSATION))).collect()}
    by = defaultdict(list)
    for conv, _, role, text in rows:
        by[conv].append((role, text))
    assert set(got) == set(by)
    for conv, own in by.items():
        faults, (cost, audit, lines) = brute_repair(own)
        r, count = got[conv], Counter(faults)
        assert (r.cost, r.audit, r.repaired_sha256) == (cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
        assert (r.blank, r.duplicate, r.truncated) == (count["b"], count["d"], count["t"])
        assert r.illegal == sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))


def test_repair_of_a_long_conversation_in_chunks(spark, monkeypatch):
    """One conversation over many tasks and chunks equals itself in one chunk."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "system"]), f"Text {rng.randrange(3000)}{rng.choice(['.', '', '!'])}") for t in range(3000)]
    found = []
    for bits in (20, 3):
        monkeypatch.setattr(dialogue, "CHUNK_BITS", bits)
        edited = dialogue.repair(spark.createDataFrame(rows, CONVERSATION).repartition(8))
        found.append(dialogue.digests(edited).collect())
        left = [r.role[0] for r in dialogue.repaired(edited).orderBy("pos", "place").collect()]
        assert re.fullmatch("(s?(ua)+)?", "".join(left))
    assert found[0] == found[1]


def test_repair_edges(spark):
    rows = [
        (None, None, None, None), (None, 0, "user", "Hi."), (None, None, "user", "Hello."), (1, 3, "user", "Q?"), (1, 3, "user", "Q?"), (1, 3, "assistant", "A."),
        (2, 1, "", "No role."), (3, 1, "user", "x" * 300000 + "."), (3, 2, "assistant", "Short."), (4, 9, "assistant", "Only."), (4, None, None, ""),
    ]
    df = spark.createDataFrame([(*r, "other", 5) for r in rows], CONVERSATION + ", pos string, edit int")
    got = {r.conv_id: r for r in dialogue.digests(dialogue.repair(df)).collect()}
    assert set(got) == {None, 1, 2, 3, 4}
    assert (got[1].cost, got[1].audit) == (10, "IKKDI")  # equal turns: by role, so the answer stands first
    assert (got[1].duplicate, got[1].gaps) == (1, 0)
    assert (got[2].cost, got[2].audit) == (4, "D")
    assert (got[3].cost, got[3].audit) == (0, "KK")
    assert got[4].blank == 1 and got[4].gaps == 0
    assert got[None].blank == 1 and got[None].audit.count("I") + got[None].audit.count("K") >= 1
    assert dialogue.digests(dialogue.repair(df.limit(0))).count() == 0


def test_damage_reports_conversations_without_rows(spark):
    dropped = [(c, t) for c in range(200) for t in range(2) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    df = spark.createDataFrame([(c, t, "user", "Hi.") for c, t in dropped], CONVERSATION)
    got = dialogue.digests(dialogue.repair(dialogue.damage(df))).collect()
    assert len(got) == len({c for c, _ in dropped}) and got
    assert all((r.gaps, r.cost, r.audit, r.repaired_sha256) == (0, 0, "", hashlib.sha256(b"").hexdigest()) for r in got)


# ---- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(counts):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        top = min(near, key=lambda v: (-counts[v], v), default=None)
        out[w] = (n, len(near), top if top is not None and counts[top] >= 10 * n else None)
    return out


@pytest.mark.parametrize("group", [4096, 6, 1])
def test_variants_equal_brute_force(spark, group):
    """Words of two letters in clusters, so that runs, edits at both ends and oversized groups all occur."""
    rng = random.Random(12)
    seeds = ["".join(rng.choice("abé") for _ in range(rng.randrange(7, 12))) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "b" * 40, "b" * 41]
    words = set(seeds)
    for s in seeds:
        for _ in range(30):
            i, c = rng.randrange(len(s) + 1), rng.choice("abé")
            words.add(rng.choice([s[:i] + c + s[i:], s[:i] + s[i + 1 :], s[:i] + c + s[i + 1 :]]))
    counts = {w: rng.choice([2, 2, 3, 25, 400]) for w in words if len(w) >= 7}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    want = {w: (k, top) for w, (_, k, _) in brute_variants(counts).items() if k for top in [min((v for v in counts if one_edit(w, v)), key=lambda v: (-counts[v], v))]}
    got = {r.word: (r.n_near, r.best) for r in spelling.near_counts(df, group).collect()}
    assert got == want


def test_variants_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = Counter()
    for r in docs.collect():
        for run, n in Counter(re.findall("[A-Za-zÀ-ÿ]+", (r.text or "").translate(LOWER))).items():
            counts[spelling.damaged(str(r.doc_id), run)] += n
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    want = brute_variants(counts)
    got = {r.word: r for r in spelling.variants(docs, group=64).collect()}
    assert {w: (r.n, r.n_near, r.form) for w, r in got.items()} == want
    for w, r in got.items():
        last = w
        while want[last][2]:
            last = want[last][2]
        assert r.root == last and r.form_n == (counts[r.form] if r.form else None)


def test_variants_edges(spark):
    long = "Langeswort" * 3000
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, "Straßenbahn Straßenbahn"), (4, "straßenbahn"), (None, long), (5, f"{long} {long}x"), (6, f"{long}x")]
    df = spark.createDataFrame([(*r, "a", 1) for r in rows], DOCS + ", word string, n int")
    got = {r.word: r for r in spelling.variants(df, least_chars=7).collect()}
    assert got["straßenbahn"].n == 3 and got["straßenbahn"].form is None and got["straßenbahn"].root == "straßenbahn"
    assert all(r.n >= 2 and len(r.word) >= 7 for r in got.values())
    assert spelling.variants(df.limit(0)).count() == 0


def test_roots_follow_chains(spark):
    chain = [("a", "b"), ("b", "c"), ("c", "d"), ("d", "e"), ("x", "e"), ("y", "x")]
    assert {tuple(r) for r in spelling.roots(spark.createDataFrame(chain, "word string, form string")).collect()} == {(w, "e") for w in "abcdxy"}


# ---- decontamination


def brute_find(docs, items, size=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))
    wins = defaultdict(set)
    for item, text in items:
        w = split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins[tuple(w[i : i + size])].add("" if item is None else str(item))
    out = []
    for doc_id, text in docs:
        w, hit, ids = split(text), set(), set()
        for n in {len(p) for p in wins}:
            for i in range(len(w) - n + 1):
                if (p := tuple(w[i : i + n])) in wins:
                    hit.update(range(i, i + n))
                    ids |= wins[p]
        out.append((str(doc_id), len(w), len(hit), sorted(ids)))
    return sorted(out)


@pytest.mark.parametrize("part_bytes", [16 << 20, 300])
def test_decontam_equals_brute_force(spark, part_bytes):
    rng = random.Random(13)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "Dé", "e9"]) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 10, 11, 30]))) for i in range(12)] + [(3, text(12)), (None, text(15)), (50, None), (51, "..."), (52, "")]
    long = [t for _, t in items if t and len(t) > 30]
    docs = [(i, f"{text(40)}, {rng.choice(long)}! {text(9)}\n{rng.choice(long)[3:]}") for i in range(25)] + [(3, text(4)), (None, long[0]), (None, long[0]), (60, None), (61, "")]
    frame = spark.createDataFrame([(*d, "x", 0) for d in docs], DOCS + ", items string, n_hit int")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, win string")
    got = decontam.find(frame, bench, part_bytes=part_bytes).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, list(r["items"])) for r in got) == brute_find(docs, items)
    assert all(r.n_hit == sum(s["end"] - s["first"] for s in r.spans) for r in got)
    assert {r.n_hit for r in decontam.find(frame, bench.limit(0)).collect()} == {0}
    assert decontam.find(frame.limit(0), bench).count() == 0


def test_decontam_repeats_rows(spark):
    df = spark.range(3).select(F.lit(5).cast("long").alias("doc_id"), F.lit("same text").alias("text")).union(spark.createDataFrame([(6, "other")], DOCS))
    made = df.groupBy("doc_id", "text").agg(F.count("*").alias("times"))
    assert decontam._repeat(made, "times", 2).groupBy("doc_id").count().orderBy("doc_id").collect() == df.groupBy("doc_id").count().orderBy("doc_id").collect()


def test_tables_jump(spark):
    """Blocks that no pattern holds let the search jump a whole window but one word."""
    words = [b"x%d" % i for i in range(1000)]
    tables = decontam.Tables([tuple(b"p%d" % i for i in range(10)), tuple(words[500:510])])
    looked = []
    tables.shift = type("Counting", (dict,), {"get": lambda self, key, far: looked.append(key) or dict.get(self, key, far)})(tables.shift)
    assert [start for start, _ in tables.occurrences(words)] == [500]
    assert len(looked) < 130
