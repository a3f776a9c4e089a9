"""MinHash near-dedup against all pairs compared one by one."""

import re
from itertools import combinations

from reviewlab.llm import minhash
from tests.llm.conftest import frame, lower_ascii


def brute(rows, k, percent):
    """{row index: (n_shingles, component)} by comparing every pair of sets."""
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower_ascii(text))
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = {}
    for i in range(len(rows)):
        ids = [rows[j][0] for j in groups[root(i)] if rows[j][0] is not None]
        out[i] = (len(sets[i]), min(ids) if ids else rows[i][0])
    return out


def check(spark, table, k=4, **options):
    got = minhash.near_components(frame(spark, table), shingle=k, **options).collect()
    want = brute(table, k, 80)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got) == \
        sorted((str(table[i][0]), n, str(c), table[i][0] == c) for i, (n, c) in want.items())
    return got


def test_documents_match_all_pairs(spark, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = check(spark, rows)
    assert any(not r.kept for r in got)


def chain(n, step, length=40):
    """Texts that slide over one long word list: neighbours are similar, the ends aren't."""
    return [" ".join(f"w{j}" for j in range(i * step, i * step + length)) for i in range(n)]


def test_chains_hot_groups_and_edges(spark):
    rows = list(enumerate(chain(40, 3))) + [(100 + i, t) for i, t in enumerate(chain(30, 7))]
    base = [f"x{j}" for j in range(60)]
    rows += [(200 + i, " ".join(base[:i] + [f"y{i}"] + base[i + 1:])) for i in range(50)]
    rows += [(300 + i, "the same text over and over again") for i in range(20)]
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "one"), (404, "ONE"), (405, "one two three"),
             (406, "One Two\nthree"), (None, "one"), (407, "é É ü"), (407, "é É ü"), (408, "long " * 30000)]
    check(spark, rows)


def test_weak_bands_lose_no_link_within_buckets(spark):
    """One value to a band makes large buckets of documents that are mostly unlike: many rounds, no loss."""
    shared = [f"c{j}" for j in range(30)]
    rows = [(i, " ".join(shared + [f"u{i}_{j}" for j in range(25)])) for i in range(60)]
    rows += [(1000 + i, rows[i][1] + " tail") for i in range(0, 60, 2)]
    check(spark, rows, perms=12, rows=1)


def test_empty_table_and_clashing_columns(spark):
    assert check(spark, []) == []
    docs = frame(spark, [(1, "a b c d e f g", "x"), (2, "a b c d e f g", "y"), (3, None, "z")],
                 "doc_id long, text string, cls string").withColumnRenamed("cls", "component_id")
    left = minhash.near_dedup(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 3]
