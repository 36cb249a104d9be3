"""Exact copies, the Merkle manifest and the filter audit: brute force, SQL twins on awkward tables, edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import pyarrow as pa
import pytest
from oracle_compare import compare

import brute
from segmint.llm import exact_dedup, merkle
from segmint.llm.exact_dedup import drop_copies, exact_groups
from segmint.llm.filter_audit import audit_filters, path_counts
from segmint.llm.merkle import build_manifest, check_manifest, leaf_digest, sweep_down, sweep_up
from segmint.llm.oracle import SQL
from segmint.llm.queries import QUERIES

#: the columns of ``documents`` and some named like the operators' own
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, row bigint, digest string, tree string, pos bigint, mask int, part string, size bigint, best string, kept string"
LANGS = ["en", None, "", "é", "zz", "日", "de"]


def awkward(seed: int = 9) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i, t in brute.documents():
        rows.append((i, t, rng.choice(LANGS), rng.choice(["src0", None]), rng.choice([None, len(t or "")])))
    rows += [(200 + k, "Same  text\tof many", "en", "src0", 18) for k in range(60)]
    rows += [(300, " Same text of many\n", "de", "src0", 19), (301, "Sametextofmany", "de", "src0", 14)]
    rows += [rows[3]] * 4 + [(400, None, None, None, None)] * 2
    rows += [(500 + k, " ".join(rng.choice("ABCdefg #$") * rng.randint(1, 4) for _ in range(rng.choice([5, 250, 400]))), rng.choice(LANGS), "s", k) for k in range(40)]
    rows += [(600, rows[-1][1], None, "s", 1), (2, rows[-1][1], "en", "s", 1), (None, rows[-1][1], "en", "s", 1)]
    return [(*r, "k", 1, "d", "t", 2, 3, "p", 4, "b", "x") for r in rows]


LABELS = [(i, i % 2, i % 3 // 2) for i in range(0, 700, 2)] + [(4, 1, 1), (4, None, None), (None, 1, 1), (90_000, 1, 1)]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with the awkward tables, as the queries read them."""
    folder = tmp_path_factory.mktemp("awkward")
    spark.createDataFrame(awkward(), SCHEMA).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def twin(folder):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    return con


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle_manifest", "op13_filter_audit"])
def test_awkward_tables_match_sql(spark, tables, name):
    ok, msg = compare(QUERIES[name](spark, tables), twin(tables), SQL[name])
    assert ok, msg


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_merkle_manifest", "op13_filter_audit"])
def test_empty_tables(spark, tables, tmp_path, name):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{tables}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


# ---- exact copies ---------------------------------------------------------------------------------


def plain_groups(rows):
    norm = lambda t: (t or "").translate({c: None for c in (9, 10, 11, 12, 13, 32)})
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    out = Counter()
    for text, members in groups.items():
        best = min(members)
        for k, m in enumerate(sorted(members)):
            out[m[3], best[3], len(members), k == 0, brute.sha(text)] += 1
    return out


@pytest.mark.parametrize("shorten", [None, lambda d: d.substr(1, 1).cast("string"), lambda d: (d.substr(1, 1) == d.substr(2, 1)).cast("string")])
def test_groups_hold_when_keys_collide(spark, shorten):
    """A key of one byte, or of one bit, joins many texts: contents keep them apart."""
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(7)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in exact_groups(docs, shorten=shorten).collect())
    assert got == plain_groups(awkward())


def test_hot_class_is_salted(spark, monkeypatch):
    """A class of a third of all rows: same result whatever the share that counts as hot; the plan names hot keys by broadcast."""
    rows = [(k, "the same" if k % 3 == 0 else f"own {k}") for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(16)
    want = plain_groups(rows)
    for share in (2, 1000):
        monkeypatch.setattr(exact_dedup, "SHARE", share)
        out = exact_groups(docs)
        assert Counter(tuple(r) for r in out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "BatchEvalPython" not in plan


def test_drop_copies_keeps_all_columns(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(3)
    out = drop_copies(docs)
    assert out.columns == docs.columns
    keep = Counter()
    for (i, _, _, kept, sha), n in plain_groups(awkward()).items():
        keep[i, sha] += n * kept
    got = Counter((r.doc_id, brute.sha("".join((r.text or "").split(" ")).translate({c: None for c in (9, 10, 11, 12, 13)}))) for r in out.collect())
    assert got == +keep


# ---- Merkle manifest -------------------------------------------------------------------------------


def h(*parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(digests):
    """(root, siblings of each leaf by level as (digest or None, leaf's bit))."""
    level, at = list(digests), list(range(len(digests)))
    paths = [[] for _ in digests]
    while len(level) > 1:
        for k, p in enumerate(at):
            other = p ^ 1
            paths[k].append((level[other] if other < len(level) else None, p & 1))
        level = [h(*level[k : k + 2]) for k in range(0, len(level), 2)]
        at = [p >> 1 for p in at]
    return level[0], paths


def plain_manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: h(*map(field, (r[0], r[3], r[2], None if r[4] is None else r[4] + more, r[1])))
    trees = defaultdict(list)
    for r in rows:
        trees[r[2]].append(r)
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    found = {}
    for g in names:
        trees[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        found[g] = plain_tree([leaf(r) for r in trees[g]])
    root, tops = plain_tree([found[g][0] for g in names])
    out = Counter()
    for g, top in zip(names, tops):
        for r, path in zip(trees[g], found[g][1]):
            now = leaf(r, 1 if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 else 0)
            path = path + top
            for other, bit in path:
                now = h(now) if other is None else h(other, now) if bit else h(now, other)
            out[r[0], leaf(r), found[g][0], root, h(*[o for o, _ in path if o]), now, now == root] += 1
    return out


NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(docs, levels):
    from pyspark.sql import functions as F

    more = leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text"))
    made = build_manifest(docs, keep=[F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, more).alias("tampered")], levels=levels)
    return Counter(tuple(r) for r in check_manifest(made, F.col("tampered")).select(*NAMES).collect())


@pytest.mark.parametrize("levels", [1, 2, 5, merkle.LEVELS])
def test_manifest_over_many_sweeps(spark, levels):
    """Blocks of 2 to 4,096 leaves give the same trees: from eight sweeps up and down to one."""
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(5)
    assert manifest(docs, levels) == plain_manifest(awkward())


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 8])
def test_manifest_of_few_rows(spark, rows):
    few = [r for r in awkward() if r[2] == "en"][:rows]
    assert manifest(spark.createDataFrame(few, SCHEMA), 2) == plain_manifest(few)


def test_tampering_shows_in_its_rows_alone(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(5)
    got = manifest(docs, 3)
    bad = {r[0] for r in got if not r[6]}
    assert bad and bad == {r[0] for r in awkward() if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0} & bad
    assert all(r[5] == r[3] for r in got if r[0] not in bad)


def test_sweeps_agree_with_plain_tree():
    for n in [*range(1, 40), 64, 65, 127]:
        leaves = [h(str(k)) for k in range(n)]
        top, found = sweep_up(leaves, (n - 1).bit_length())
        root, paths = plain_tree(leaves)
        mark = [[("S" if o is None else "LR"[1 - b] + o) for o, b in p] for p in paths]
        assert top == root and [list(p) for p in sweep_down(found, ())] == mark


def test_all_columns_of_blocks_come_through_cuts():
    """Blocks that end, start and run on at batch borders."""
    rows = [("t", k // 3, k % 3) for k in range(10)] + [("u", 0, 0)]
    for size in (1, 2, 3, 4, 11):
        batches = [pa.RecordBatch.from_pylist([dict(zip("abc", r)) for r in rows[k : k + size]]) for k in range(0, len(rows), size)]
        cut = [t.num_rows for t in merkle._cut(batches)]
        assert cut == [3, 3, 3, 1, 1]


# ---- filter audit -----------------------------------------------------------------------------------


def plain_audit(rows, labels):
    first, good, toxic = {}, set(), set()
    for i, t, *_ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if x == 1 else set()
    parts = defaultdict(list)
    for i, t, lang, *_ in rows:
        t = t or ""
        w = brute.words_of(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and i > first[t]}
        parts[lang or ""].append((i, {f for f, v in fails.items() if v}))
    out, sums = Counter(), Counter()
    lines = []
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left = docs
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                sums[part, f] += len(gone)
                lines.append((part, "".join(order), step, f, len(left), len(gone), sum(f in d[1] for d in docs) - len(gone), sum(d[1] == {f} for d in docs),
                              sum(d[0] in good and d[0] is not None for d in gone), sum(d[0] in toxic and d[0] is not None for d in gone)))
    for part, order, step, f, *counts in lines:
        out[part, order, step, *counts, sums[part, f]] += 1
    return out


def test_audit_matches_step_by_step_filtering(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA).repartition(4)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    got = Counter(tuple(r) for r in audit_filters(docs, labels).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect())
    assert got == plain_audit(awkward(), LABELS)


def test_path_counts_are_orders():
    for k in (1, 2, 5):
        forward, backward = path_counts(k)
        reach, leave = Counter(), Counter()
        for order in permutations(range(k)):
            seen = 0
            for s in range(k + 1):
                reach[seen, order[:s]] = leave[seen, order[s:]] = 1
                seen |= 1 << order[s] if s < k else 0
        assert forward == [sum(n for (s, _), n in reach.items() if s == t) for t in range(1 << k)]
        assert backward == [sum(n for (s, _), n in leave.items() if s == t) for t in range(1 << k)]


def test_own_filters(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([(1, "a", "x"), (2, "a", "x"), (3, "bb", None)], "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(2, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.good_lost, r.shapley) for r in audit_filters(docs, labels, {"L": F.length("text") > 1}, copies="K").collect()}
    assert got == {("x", "LK", 1): (2, 0, 0, 0), ("x", "LK", 2): (1, 1, 1, 2), ("x", "KL", 1): (1, 1, 1, 2), ("x", "KL", 2): (1, 0, 0, 0),
                   ("", "LK", 1): (0, 1, 0, 2), ("", "LK", 2): (0, 0, 0, 0), ("", "KL", 1): (1, 0, 0, 0), ("", "KL", 2): (0, 1, 0, 2)}
    with pytest.raises(ValueError):
        audit_filters(docs, labels, {"E": F.lit(True)})
