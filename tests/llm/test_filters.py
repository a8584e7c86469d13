"""op1, op3, op4, op5 and op6 against plain versions, the registration, and the pipeline."""

import hashlib
import heapq
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from pyspark.sql import functions as F
from pyspark.sql import types as T
from riskloom.llm import decontaminate, minhash_forest, sharding, toxicity, url_filters, warc
from riskloom.llm.common import ship_package
from riskloom.llm.queries import ORACLES, QUERIES, RULES
from tests.conftest import SF
from tests.llm.fixtures import ascii_lower, docs_df, mixed_docs, sentence
from tests.llm.test_pairs import plain_groups, plain_removal
from tools.check_queries import connect

# ---- op1

PAGE = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("bad", T.BooleanType()),
                     T.StructField("host", T.StringType()), T.StructField("template", T.StringType())])


def plain_url(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return (ascii_lower(m[1]), m[2]) if m else ("", "")


def plain_rule(host, path):
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return (best.text, best.verdict) if best else (None, None)


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://net/x", "HTTP://A.Example.NET/en/1?x#y", "https://example.net/de/1", "http://example.com/de/",
            "http://notexample.com/de/", "http://b.example.com/de", "http://a.b.org/fr/x", "http://org/fr/", "http://xorg/fr/", "http://net",
            "http://net?/", "x://y://z/a", "http://ÄB.net/\nz", "://net/", "http://user@example.com/de/1"]
    df = spark.createDataFrame([(i, u, None, "h", "t") for i, u in enumerate(urls)] + [(3, urls[3], None, "h", "t")], PAGE)
    got = url_filters.judge_urls(df, RULES, bad_col="bad").collect()
    assert len(got) == len(urls) + 1
    for r in got:
        host, path = plain_url(urls[r["page_id"]])
        rule, verdict = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (verdict or "allow")
    assert url_filters.judge_urls(df.limit(0), RULES, bad_col="bad").count() == 0
    assert {r["verdict"] for r in url_filters.judge_urls(df.drop("bad"), RULES).collect()} == {"allow", "block"}


def share_differs(seen, bad, other_seen, other_bad):
    """Two-proportion test."""
    if not seen or not other_seen:
        return False
    pooled = (bad + other_bad) / (seen + other_seen)
    return abs(bad / seen - other_bad / other_seen) > 1.96 * math.sqrt(pooled * (1 - pooled) * (1 / seen + 1 / other_seen))


def plain_tree(rows):
    """(host, path, bad) rows to (template, verdict), by a recursion over segments, one after the other."""
    paths = [[s for s in p.split("/") if s] for _, p, _ in rows]
    template, parent = [""] * len(rows), [None] * len(rows)

    def counts(ids):
        labels = [rows[i][2] for i in ids if rows[i][2] is not None]
        return len(labels), sum(labels)

    def grow(ids, at):
        start = template[ids[0]]
        seen, bad = counts([i for i in ids if len(paths[i]) > at])
        may_split = seen >= 10 and 0 < bad < seen
        while ids := [i for i in ids if len(paths[i]) > at]:
            values = defaultdict(list)
            for i in ids:
                values[paths[i][at]].append(i)
            seen, bad = counts(ids)
            stays = set()
            for value, of in values.items():
                s, b = counts(of)
                own = len(of) >= 0.01 * len(ids) or s >= 5 and share_differs(s, b, seen - s, bad - b)
                if may_split and 5 <= len(of) < len(ids) and own:
                    stays.add(value)
            at += 1
            for i in ids:
                same = may_split and len(values) == 1
                template[i] += "/" + (paths[i][at - 1] if same or paths[i][at - 1] in stays else "*")
            if stays:
                groups = defaultdict(list)
                for i in ids:
                    parent[i] = (start, at)
                    groups[template[i]].append(i)
                for of in groups.values():
                    grow(of, at)
                return

    hosts, leaves = defaultdict(list), defaultdict(list)
    for i, (host, _, _) in enumerate(rows):
        hosts[host].append(i)
    for ids in hosts.values():
        grow(ids, 0)
    for i, (host, _, _) in enumerate(rows):
        leaves[host, parent[i]].append(i)
    seen, bad = counts(range(len(rows)))
    base, verdict = bad / (seen + 1), {}
    for ids in leaves.values():
        groups = defaultdict(list)
        for i in ids:
            groups[template[i]].append(i)
        ordered = sorted((((b + 10 * base) / (s + 10), t, s, b) for t, of in groups.items() for s, b in [counts(of)]))
        branches, before = [], None
        for _, t, s, b in ordered:
            if before is None or share_differs(s + 1, b + base, before[0] + 1, before[1] + base):
                branches.append([])
            branches[-1].append((t, s, b))
            before = s, b
        for branch in branches:
            purity = (sum(x[2] for x in branch) + 10 * base) / (sum(x[1] for x in branch) + 10)
            for t, _, _ in branch:
                for i in groups[t]:
                    verdict[i] = "block" if purity >= 0.5 else "allow"
    return [(t or "/", verdict[i]) for i, t in enumerate(template)]


def test_url_tree_of_deep_paths(spark):
    """Paths whose good and bad pages part at the second, fifth and eighth segment, of all lengths, against the recursion."""
    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        host = rng.choice(["a.test", "a.test", "b.test", "c.test", ""])
        part = [rng.choice("xy"), rng.choice(["ads", "blog", "wiki"]), "same", str(rng.randrange(10**6)), rng.choice("pqr"), "fix",
                str(rng.randrange(300)), rng.choice(["win", "home"]), str(rng.randrange(10**6)), "end"]
        part = part[:rng.choice([0, 1, 2, 4, 5, 8, 9, 10, 10])]
        odds = 0.05 + 0.9 * ("ads" in part or "q" in part[4:5] or part[7:8] == ["win"])
        bad = None if rng.random() < 0.3 or host == "c.test" else rng.random() < odds
        rows.append((host, "/" + "/".join(part), bad))
    rows += [("long.test", "/" + "/".join(f"{i}-{j}" for j in range(300)) + ("/bad" if i % 2 else "/good"), i % 2 == 1) for i in range(40)]
    df = spark.createDataFrame([(i, f"http://{h}{p}", bad, "h", "t") for i, (h, p, bad) in enumerate(rows)], PAGE)
    got = {r["page_id"]: (r["template"], r["verdict"]) for r in url_filters.judge_urls(df, [], bad_col="bad").collect()}
    want = plain_tree(rows)
    assert [got[i] for i in range(len(rows))] == want
    assert {want[i][1] for i in range(1500, 1540)} == {"allow", "block"} and len({t for t, _ in want}) > 40


def test_url_templates_and_purity(spark):
    rng = random.Random(0)
    rows = []
    for i in range(400):
        kind = rng.choice(["spam", "blog", "news"])
        bad = None if rng.random() < 0.2 else kind == "spam" and rng.random() < 0.9
        rows.append((i, f"http://site.test/{kind}/{rng.randrange(10**6)}", bad, "h", "t"))
    rows += [(1000 + i, f"http://rare.test/{i}/a/b/c", True, "h", "t") for i in range(2)]
    df = spark.createDataFrame(rows, PAGE)
    got = {r["page_id"]: r for r in url_filters.judge_urls(df, RULES, bad_col="bad").collect()}
    assert [got[i]["template"] for i in range(400)] == [f"/{rows[i][1].split('/')[3]}/*" for i in range(400)]
    assert {got[i]["verdict"] for i in range(400) if "/spam/" in rows[i][1]} == {"block"}
    assert {got[i]["verdict"] for i in range(400) if "/spam/" not in rows[i][1]} == {"allow"}
    # blog and news are similar and merged, so they share one purity
    assert len({got[i]["purity"] for i in range(400)}) == 2
    assert got[1000]["template"] == "/*/*/*/*" and got[1000]["verdict"] == "allow"


def test_small_sections_of_a_host_with_many(spark):
    """200 sections of 0.5 % each: those with bad pages only go, the others stay."""
    rows = [(i, f"http://many.test/s{i % 200}/{i}", i % 200 < 20, "h", "t") for i in range(200 * 12)]
    got = url_filters.judge_urls(spark.createDataFrame(rows, PAGE), RULES, bad_col="bad").collect()
    assert {(r["page_id"], r["verdict"]) for r in got} == {(i, "block" if bad else "allow") for i, _, bad, _, _ in rows}


# ---- op3

def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))


def plain_hits(docs, items):
    windows = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        for s in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[s:s + 10])].add(str(i))
    out = []
    for i, t in docs:
        w, hit, names = item_words(t), set(), set()
        for n in {len(x) for x in windows}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in windows:
                    hit.update(range(s, s + n))
                    names |= windows[k]
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=str)


ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("doc", T.StringType()),
                     T.StructField("window", T.StringType())])


def items_df(spark, rows):
    return spark.createDataFrame([(i, t, "d", "w") for i, t in rows], ITEM)


def contaminated_tables():
    rng = random.Random(4)
    long = sentence(rng, 25)
    items = [(1, long), (2, long), (10, sentence(rng, 10)), (3, "Zebra crossing"), (4, "solo"), (5, ""), (6, None), (7, "a a a a a a a a a a a a"),
             (8, "É b-c_d 9.ß"), (9, "...")]
    w = long.split()
    docs = [(1, "x " + long.upper() + " y"), (2, " ".join(w[3:13])), (3, " ".join(w[3:12])), (4, "see zebra, CROSSING: Solo!"),
            (5, "a " * 11), (6, "a " * 9), (7, None), (8, ""), (9, "pre É B c d 9 ß post"), (10, long + " gap " + items[2][1] + " " + long),
            (11, " ".join(w[:9]) + " other " + " ".join(w[10:])), (1, "another text, solo"), (3, " ".join(w[3:12])), (None, "solo")]
    return docs, items


def test_contamination(spark):
    docs, items = contaminated_tables()
    got = decontaminate.contamination(docs_df(spark, docs), items_df(spark, items)).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == plain_hits(docs, items)
    clean = decontaminate.clean_documents(docs_df(spark, docs), items_df(spark, items))
    want = [(i, t) for i, t in docs if not plain_hits([(i, t)], items)[0][5]]
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(want, key=str)
    assert clean.columns == docs_df(spark, []).columns


def test_contamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    docs, items = contaminated_tables()
    got = decontaminate.contamination(docs_df(spark, docs), items_df(spark, items)).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == plain_hits(docs, items)


def test_contamination_of_empty_tables(spark):
    docs, items = contaminated_tables()
    assert decontaminate.contamination(docs_df(spark, []), items_df(spark, items)).count() == 0
    got = decontaminate.contamination(docs_df(spark, docs), items_df(spark, [])).drop("spans").collect()
    assert sorted(map(tuple, got), key=str) == plain_hits(docs, [])


# ---- op4

def toxic_tables(n=300, seed=1):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        w = sentence(rng, rng.randint(20, 120)).split()
        toxic = i % 4 == 0
        for _ in range(rng.randint(1, 4) if toxic else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["Vile", "nastybit", "nastyhaft", "nastyly"]) + rng.choice(["", ",", "!"]))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


LABEL = "doc_id long, quality int, toxic int"


def test_toxicity_held_out(spark):
    ship_package(spark)
    docs, labels = toxic_tables()
    docs += [(1000, None), (1001, ""), (1002, "nastynew and vile"), (1002, "nastynew and vile")]
    half = spark.createDataFrame(labels[:200] + [(0, None, None), (None, 0, 1)], LABEL)
    got = toxicity.toxicity(docs_df(spark, docs), half).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(docs)
    unseen = [(by_id[i]["toxic"], bool(t)) for i, _, t in labels[200:]]
    assert sum(a == b for a, b in unseen) >= 0.97 * len(unseen)
    assert by_id[1002]["toxic"] and not by_id[1000]["toxic"] and not by_id[1001]["toxic"]
    assert all(0 <= r["expected_severity"] <= toxicity.TOP_GRADE for r in got)
    one, many = (min(r["expected_severity"] for r in got if r["toxic"]), max(r["expected_severity"] for r in got))
    assert many > one > max(r["expected_severity"] for r in got if not r["toxic"])


def test_toxicity_without_labels(spark):
    ship_package(spark)
    docs, labels = toxic_tables(40)
    for rows in ([], [r for r in labels if not r[2]], [r for r in labels if r[2]]):
        got = toxicity.toxicity(docs_df(spark, docs), spark.createDataFrame(rows, LABEL)).collect()
        assert len(got) == 40 and not any(r["toxic"] for r in got)
    assert toxicity.toxicity(docs_df(spark, []), spark.createDataFrame(labels, LABEL)).count() == 0


def test_thresholds_stay_in_order():
    rng = np.random.default_rng(0)
    grades = rng.integers(0, 4, 200)
    rows, cols = np.repeat(np.arange(200), grades), np.concatenate([np.arange(g) for g in grades])
    weights, thresholds = toxicity.fit_ordinal(rows, cols, grades, 3)
    assert (np.diff(thresholds) > 0).all() and (weights > 0).all()
    model = toxicity.OrdinalModel(np.arange(3, dtype=np.uint64), weights, thresholds)
    severity = model.above(np.cumsum(np.append(0, weights))).sum(1)
    assert (np.diff(severity) > 0).all() and abs(severity[0]) < 0.5 and severity[3] > 2.5


# ---- op5

def pages_table(spark, rows):
    shape = "page_id long, url string, html string, payload string, archive int"
    return spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in rows], shape)


def page_rows():
    rng = random.Random(6)
    big = "".join(rng.choices("abcdefgh <>é漢", k=60_000))
    rows = [(i, f"http://h/{i}", "".join(rng.choices("abc <p>", k=rng.randint(0, 3000)))) for i in range(60)]
    rows += [(100, "u", big), (90, "u\r\nX: y", big), (101, None, big), (102, "é ü", "short"), (95, "v", "short"), (96, "v", None), (97, "v", ""),
             (98, "v", "y" * 100), (99, "v", "y" * 100), (103, "v", "y" * 99), (104, "v", "y" * 99), (90, "u\r\nX: y", big), (None, "n", big)]
    return rows


def plain_records(rows):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    return sorted(((i, (h or ""), *(("revisit", first[h]) if h in first and i != first[h] else ("response", None))) for i, _, h in rows), key=str)


@pytest.mark.parametrize("size", [1 << 20, 700])
def test_warc_round_trip(spark, tmp_path, size):
    """Also with ranges that are much smaller than a record."""
    ship_package(spark)
    rows = page_rows()
    folder = f"file://{tmp_path}/a"
    written = warc.write_archives(warc.plan_records(pages_table(spark, rows)), folder)
    assert written.agg(F.sum("records")).head()[0] == len(rows)
    back = warc.read_archives(written, size).collect()
    want = plain_records(rows)
    assert sorted(((r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in back), key=str) == sorted(
        ((i, k, ref, len(h.encode()), hashlib.sha256(h.encode()).hexdigest()) for i, h, k, ref in want), key=str)
    assert all(bytes(r["payload"]).decode() == dict((i, h or "") for i, _, h in rows)[r["page_id"]] for r in back if r["record_type"] == "response")
    assert all(r["record_digest"] == r["payload_digest"] for r in back if r["record_type"] == "response")
    listed = warc.read_archives(warc.list_archives(spark, folder), size)
    assert listed.count() == len(rows)


def test_warc_reader_ignores_false_magic(spark, tmp_path):
    ship_package(spark)
    a = warc.member(1, "u", "response", None, "d", 3, b"abc")
    stored = warc.member(2, "u", "response", None, "d", 5, warc.MAGIC + b"xx")
    other = zlib.compressobj(wbits=31)
    junk = other.compress(b"no record here") + other.flush()
    data = b"\0" * 7 + warc.MAGIC + a + junk + warc.MAGIC * 3 + stored + warc.MAGIC
    (tmp_path / "x.warc.gz").write_bytes(data)
    for size in (1, 16, 97, 10_000):
        got = warc.read_archives(warc.list_archives(spark, str(tmp_path)), size).collect()
        assert sorted((r["page_id"], bytes(r["payload"])) for r in got) == [(1, b"abc"), (2, warc.MAGIC + b"xx")]


def test_warc_of_no_pages(spark, tmp_path):
    ship_package(spark)
    none = warc.write_archives(warc.plan_records(pages_table(spark, [])), f"file://{tmp_path}/none")
    assert none.count() == 0 and warc.read_archives(none).count() == 0


# ---- op6

def test_shards(spark):
    rows = mixed_docs() + [(7, "same"), (7, "same"), (8, "same")]
    got = sharding.shard_documents(docs_df(spark, rows), 5).collect()
    text = defaultdict(list)
    for i, t in rows:
        text[i].append(t or "")
    assert len(got) == len(rows)
    where, loads, slots = {}, Counter(), defaultdict(list)
    for r in got:
        t = text[r["doc_id"]][0]
        assert r["size"] == len(t.encode()) + 16 and r["text_crc32"] == zlib.crc32(t.encode())
        assert where.setdefault(t, r["shard"]) == r["shard"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # plain longest-processing-time scheduling
    groups = Counter()
    for _, t in rows:
        groups[hashlib.sha256((t or "").encode()).hexdigest()] += len((t or "").encode()) + 16
    heap = [0] * 5
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert sorted(loads.values()) == sorted(heap)
    assert sharding.shard_documents(docs_df(spark, []), 5).count() == 0


def test_shards_of_many_small_groups(spark, monkeypatch):
    """Every group is scheduled, however small: loads are those of a plain heap."""
    monkeypatch.setattr(sharding, "SLOT_CHUNK", 37)
    monkeypatch.setattr(sharding, "FREQUENT", 20)
    rng = random.Random(0)
    rows = [(i, sentence(rng, rng.randint(1, 30))) for i in range(300)] + [(1000 + i, f"{i:05d}") for i in range(900)]
    rows += [(5000 + i, "copy") for i in range(600)] + [(7000 + i, None) for i in range(10)]
    got = sharding.shard_documents(docs_df(spark, rows), 5).collect()
    loads, slots, where = Counter(), defaultdict(list), {}
    text = dict(rows)
    for r in got:
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert where.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and sum(map(len, slots.values())) == len(rows)
    groups = Counter()
    for _, t in rows:
        groups[t or ""] += len((t or "").encode()) + 16
    heap = [0] * 5
    for size in sorted(groups.values(), reverse=True):
        heapq.heapreplace(heap, heap[0] + size)
    assert sorted(loads.values()) == sorted(heap)


def test_equal_sizes_dealt_in_one_step(monkeypatch):
    rng = random.Random(1)
    for _ in range(200):
        sizes = [(size, rng.randint(1, 60)) for size in sorted(rng.sample(range(1, 400), 6), reverse=True)]
        shards = rng.randint(1, 7)
        monkeypatch.setattr(sharding, "TURNS", 10**9)
        by_turns = list(sharding.schedule(sizes, shards))
        monkeypatch.setattr(sharding, "TURNS", 0)
        assert list(sharding.schedule(sizes, shards)) == by_turns


# ---- registration and pipeline

def rows_of(names, rows):
    at = [names.index(c) for c in sorted(names)]
    return sorted(tuple(str(r[i]) for i in at) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_registered_sql(spark, name):
    df = QUERIES[name](spark, SF)
    cur = connect(SF).execute(ORACLES[name])
    assert rows_of(df.columns, df.collect()) == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_all_are_registered():
    import __spark_entry__
    found = [q for q in __spark_entry__.queries() if re.match(r"op\d+_|pipeline$", q)]
    assert sorted(q.split("_")[0] for q in found) == sorted([*(f"op{n}" for n in range(1, 14)), "pipeline"])
    assert set(ORACLES) < set(QUERIES)


def pipeline_tables(tmp_path, spark):
    rng = random.Random(8)
    docs, labels = toxic_tables(120, 3)
    items = [(1, sentence(rng, 14)), (2, "very short item")]
    passage = sentence(rng, 55)
    docs += [(200, docs[1][1]), (201, docs[1][1] + " more"), (202, "start " + passage), (203, passage + " end here"), (204, passage),
             (205, "before " + items[0][1] + " behind"), (206, "has a Very SHORT item"), (207, None), (208, ""), (209, "clean  text")]
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    path = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], shape).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABEL).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items


def test_pipeline(spark, tmp_path):
    path, docs, items = pipeline_tables(tmp_path, spark)
    model = {r["doc_id"]: r["toxic"] for r in toxicity.toxicity(
        spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")).collect()}
    left = [(i, t) for i, t in docs if not model[i]]
    assert {i for i, t in docs if i < 120 and i % 4 == 0} <= {i for i, bad in model.items() if bad}
    kept = {i for i, _, _, keep in plain_groups(left) if keep}
    left = [(i, t) for i, t in left if i in kept]
    text = dict(left)
    left = [(i, k if gone else text[i]) for i, n, gone, k in plain_removal(left) if not n or gone < n]
    dirty = {r[0] for r in plain_hits(left, items) if r[5]}
    want = sorted((i, t or "") for i, t in left if i not in dirty)
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted((r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == [(i, lib.encode(t, add_special_tokens=False).ids) for i, t in want]
    assert all(r["decoded_sha256"] == hashlib.sha256(dict(want)[r["doc_id"]].encode()).hexdigest() for r in got)
    ids = {i for i, _ in want}
    assert {1, 202, 207, 208, 209} <= ids and not {200, 203, 204, 205, 206} & ids


def test_near_copies_between_80_and_85_percent(spark):
    words = sentence(random.Random(6), 100, 10**6).split()
    edited = [f"edit{i}" if i in (30, 60) else w for i, w in enumerate(words)]
    first, second = ({tuple(w[i:i + 5]) for i in range(96)} for w in (words, edited))
    assert 0.80 <= len(first & second) / len(first | second) < 0.85
    docs = docs_df(spark, [(7, " ".join(words)), (4, " ".join(edited)), (9, "another text")])
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [4, 9]


def test_near_duplicates_without_ids(spark):
    words = sentence(random.Random(7), 100, 10**6).split()
    near = " ".join([*words[:99], "other"])
    rows = [(3, " ".join(words)), (None, near), (None, " ".join(words)), (None, "only here"), (None, "Only  here"), (None, "one more"), (5, None)]
    got = corpus_pipeline.drop_near_duplicates(spark, docs_df(spark, rows), "")
    assert got.columns == docs_df(spark, rows).columns
    found = sorted((r["doc_id"] or 0, ascii_lower(" ".join((r["text"] or "").split()))) for r in got.collect())
    assert found == [(0, "one more"), (0, "only here"), (3, " ".join(words)), (5, "")]


def test_texts_of_one_id_are_judged_for_themselves(spark):
    """A copy goes although its id has another text that stays."""
    rows = [(3, "one two three four five six"), (7, "one two three four five six"), (7, "something else altogether, really")]
    got = corpus_pipeline.drop_near_duplicates(spark, docs_df(spark, rows), "")
    assert sorted((r["doc_id"], r["text"]) for r in got.collect()) == [rows[0], rows[2]]


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    path, docs, _ = pipeline_tables(tmp_path, spark)
    names = ["_key", "key", "mark", "row", "_own_id", "_own_version", "n_words", "n_removed", "kept", "copy", "doc", "component_id"]
    docs = spark.read.parquet(f"{path}/documents.parquet").select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns
        for r in out.collect():
            assert all(r[n] == f"{n}{r['doc_id']}" for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, path).count() == docs.count()


def test_first_depth_follows_the_threshold():
    assert minhash_forest.depths_for(85) == minhash_forest.DEPTHS
    for percent in (50, 80, 85, 95):
        depth = minhash_forest.depths_for(percent)[0]
        assert (1 - (percent / 100) ** depth) ** minhash_forest.TREES <= 2e-6


def test_stages_on_empty_tables(spark, tmp_path):
    shape = "doc_id long, text string, lang string, source string, n_chars long"
    path = str(tmp_path)
    spark.createDataFrame([], shape).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], LABEL).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
    assert os.path.basename(corpus_pipeline.__file__) == "corpus_pipeline.py"
