"""Source audit, mixing and the Merkle manifest against brute force, with their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from nivalis.llm import merkle, mixing, ordering, source_audit

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, part int, size string, tree string, "
          "term string, pos string, seq string, level string, digest string")


def docs_of(spark, rows):
    """Rows (doc_id, text, lang, source, n_chars) with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, 7, "x", "t", "y", "p", "s", "l", "d") for r in rows], SCHEMA)


# ---------------------------------------------------------------- source audit

def brute_audit(rows, least, top):
    lower = {c: c + 32 for c in range(65, 91)}
    df, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower)))
        groups[lang].add(source)
        df[lang].update(terms.keys())
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in df[lang].items() if n >= least)
        whole = Counter({t: sum(counts[lang, s][t] for s in sources) for t in kept})

        def p_of(c):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}
        p, q = {s: p_of(counts[lang, s]) for s in sources}, p_of(whole)
        for g in sources:
            pair = [(sum(abs(p[g][t] - p[h][t]) for t in kept), h) for h in sources if h != g]
            term = [(p[g][t] - q[t], t) for t in kept if counts[lang, g][t] and p[g][t] > q[t]]
            for part, items, last in (("pair", pair, None), ("term", term, top)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, g, part, item, v, i) for i, (v, item) in enumerate(items[:last], 1)]
    return sorted(out)


def audit_rows():
    rng = random.Random(3)
    words = ["Alpha", "beta", "gamma", "éa", "𝄞x", "zz", "Zeta", "eta", "theta", "x1y"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12))), rng.choice(["en", "de", None]),
             rng.choice(["a", "b", "c", "é", "", None, "d"]), 3) for i in range(120)]
    rows += rows[:5]
    rows += [(500, None, "en", "quiet", 0), (501, "", "xx", "one", 0), (502, "only once", "yy", "p", 0),
             (503, "else", "yy", "q", 0), (504, "Alpha " * 40_000, "en", "long", 9), (505, "a-b a_b 1 2", "en", "a", 1)]
    return rows


@pytest.mark.parametrize("entries, block, sources", [(None, None, None), (7, 2, 4)])
def test_audit_against_brute_force(spark, monkeypatch, entries, block, sources):
    if entries:  # spills after a few counts, several blocks of sources, several slices of languages
        for name, value in (("ENTRIES", entries), ("KEPT", entries), ("BLOCK", block), ("SOURCES", sources), ("SLAB", 4)):
            monkeypatch.setattr(source_audit, name, value)
    rows = audit_rows()
    got = source_audit.audit(docs_of(spark, rows).repartition(3), least=3, top=4).collect()
    assert sorted(tuple(r) for r in got) == brute_audit(rows, 3, 4)


def test_audit_of_an_empty_table(spark):
    assert source_audit.audit(docs_of(spark, audit_rows()).limit(0)).count() == 0


def test_shares_are_exact_for_large_counts():
    import numpy as np
    rng = random.Random(1)
    totals = [rng.randint(1, 8 * 10**15) for _ in range(500)] + [1, 3, 8 * 10**15]
    counts = [rng.randint(0, t) for t in totals]
    got = source_audit.share(np.array(counts), np.array(totals)).tolist()
    assert got == [1 + 10**9 * c // t for c, t in zip(counts, totals)]


# ---------------------------------------------------------------- mixing

def brute_targets(sizes, weights, most):
    """Share, stop at the bound, share the excess again until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, words = {}, set(order), sum(sizes.values())
    while free:
        each = words / sum(w[s] for s in free)
        over = {s for s in free if each * w[s] >= most * sizes[s]}
        if not over:
            target |= {s: each * w[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            words -= target[s]
        free -= over
    return target


def brute_mix(rows, weights, most, tilt, seed=20):
    docs = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _, s, _ in rows]
    sizes = Counter()
    for _, s, n in docs:
        sizes[s] += n
    target = brute_targets(sizes, weights, most)
    out = []
    for s, words in sizes.items():
        mine = [(d, n) for d, x, n in docs if x == s]
        full = sum(n > 0 for _, n in mine)
        rate = target[s] / words if words else 0
        copies = math.floor(rate)
        room, last, open_ = math.floor(target[s] - copies * words), 1 << 62, True
        part, left = rate - copies, []

        def q(d, n):
            u = (int(hashlib.md5(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return u / (1 - u) / (part / (1 - part) * (words / full / n) ** tilt) if part else 0
        out += [(d, s, 0, words, 0, 0) for d, n in mine if not n]
        for d, n in sorted((x for x in mine if x[1]), key=lambda x: (q(*x), x[0] is not None, x[0] or 0, x[1])):
            took = open_ and n <= room
            if open_ and room < n <= last:
                open_, last = room * mixing.CLOSE > target[s], room
            room -= n if took else 0
            out.append((d, s, n, words, copies + took, n * (copies + took)))
            if not took:
                left.append((n, len(out) - 1))
        if room * mixing.CLOSE > target[s] and left and min(left)[0] < 2 * room:
            n, at = min(left)
            out[at] = (*out[at][:4], copies + 1, n * (copies + 1))
    return target, out


def mix_rows():
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * int(rng.paretovariate(0.9))), "en", rng.choice(["b", "a", "a", "a", "", None, "é", "Z"]), 1)
            for i in range(400)]
    rows += [(900 + i, "x\ty\n z\x0b", "en", "tiny", 2) for i in range(3)] + [(None, "p q", None, "tiny", 2)]
    rows += rows[:4] + [(7, "other text of a used id", "en", "a", 1)]
    rows += [(990, None, "en", "empty", 0), (991, " \t", "en", "empty", 0), (992, "big " * 30_000, "en", "Z", 0),
             (993, "one big " * 900, "en", "a", 0)]
    return rows


@pytest.mark.parametrize("sources, weights, most, tilt", [(None, (5, 2, 1), 3, 0.5), (0, (5, 2, 1), 3, 0.5), (None, (1, 9), 2, 0.0)])
def test_mixing_against_brute_force(spark, monkeypatch, sources, weights, most, tilt):
    if sources is not None:
        monkeypatch.setattr(mixing, "BROADCAST_SOURCES", sources)
    rows = mix_rows()
    got = mixing.mix(docs_of(spark, rows).repartition(5), weights, most, tilt).collect()
    target, want = brute_mix(rows, weights, most, tilt)

    def key(t):
        return tuple((x is not None, x) for x in t)
    assert (sorted([(r.doc_id, r.source, r.size, r.source_size, r.copies, r.taken) for r in got], key=key)
            == sorted(want, key=key))
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source], rel=1e-12)
        assert r.taken <= most * r.size
        taken[r.source] += r.taken
    for s, t in target.items():
        longest = max((r.size for r in got if r.source == s), default=0)
        assert abs(t - taken[s]) <= max(1, 0.02 * t, longest / 2 if s in ("Z", "tiny") else 0), s


def test_mixing_agrees_with_itself_and_takes_empty_tables(spark):
    docs = docs_of(spark, mix_rows())
    first, second = (sorted(map(str, mixing.mix(docs.repartition(n)).collect())) for n in (2, 7))
    assert first == second
    assert mixing.mix(docs.limit(0)).count() == 0
    quiet = mixing.mix(docs.filter("source = 'empty'")).collect()
    assert [(r.target, r.taken, r.source_size) for r in quiet] == [(0.0, 0, 0)] * 2


def test_inclusion_follows_the_odds(spark):
    """Longer texts of one source are drawn less often; at tilt 0 they are not."""
    rows = [(i, "w " * (4 if i % 2 else 64), "en", "a" if i < 4000 else "b", 1) for i in range(6000)]
    rates = {}
    for tilt in (0.0, 0.5):
        got = mixing.mix(docs_of(spark, rows), weights=(1, 5), tilt=tilt).filter("source = 'a'").collect()
        rates[tilt] = [sum(r.taken > 0 for r in got if r.size == n) / 2000 for n in (4, 64)]
    assert abs(rates[0.0][0] - rates[0.0][1]) < 0.05
    odds = [p / (1 - p) for p in rates[0.5]]
    assert odds[0] / odds[1] == pytest.approx(4, rel=0.25)  # (64 / 4) ** 0.5


def test_running_sums_over_ranges(spark):
    rows = [("g" if i % 3 else "h", i % 50, i) for i in range(1000)]
    df = spark.createDataFrame(rows, "g string, k int, v long")
    got = ordering.running(ordering.place(df, ["g"], ["k", "v"], "t-order", 7), ["g"], ["k", "v"], ["v"]).collect()
    for g in "gh":
        mine, total = sorted((r[1], r[2]) for r in rows if r[0] == g), 0
        for pos, (k, v) in enumerate(mine):
            total += v
            mine[pos] = (pos, k, v, total)
        assert sorted((r.pos, r.k, r.v, r.v_run) for r in got if r.g == g) == mine


# ---------------------------------------------------------------- Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        x = levels[-1]
        levels.append([h(*x[i : i + 2]) for i in range(0, len(x), 2)])
    return levels


def brute_steps(levels, i):
    for x in levels[:-1]:
        yield ("L", x[i - 1]) if i % 2 else ("R", x[i + 1]) if i + 1 < len(x) else ("-", "")
        i //= 2


def brute_manifest(rows):
    def leaf(r, add=0):
        d, text, lang, source, n = r
        n = None if n is None else n + add
        return h(*["-" if x is None else f"{len(str(x).encode())}:{x}" for x in (d, source, lang, n, text)])
    langs = defaultdict(list)
    for r in rows:
        langs[r[2]].append(r)
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = brute_tree([leaf(r) for r in langs[lang]])
    top = brute_tree([trees[x][-1][0] for x in order])
    out = []
    for k, lang in enumerate(order):
        for i, r in enumerate(langs[lang]):
            steps = [*brute_steps(trees[lang], i), *brute_steps(top, k)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, 1 if hit else 0)
            for mark, other in steps:
                node = h(other, node) if mark == "L" else h(node, other)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], h(*[x for _, x in steps]), node, node == top[-1][0]))
    return out


def tree_rows(n):
    rng = random.Random(n)
    rows = [(i * 3 - 50, f"text {i} é", rng.choice(["en", "en", "en", "de", None, "", "zh"]), rng.choice([None, "s", ""]), i)
            for i in range(n)]
    return rows + [(None, None, None, None, None), (4, "", "en", "", None), (4, "", "en", "", None), (4, "b", "en", "", 2**63 - 1),
                   (21, "y" * 200_000, "fr", "s", 2**63 - 1)]


@pytest.mark.parametrize("span, step, trees", [(12, 4, 100), (4, 2, 100), (3, 2, 0)])
def test_manifest_against_brute_force(spark, monkeypatch, span, step, trees):
    monkeypatch.setattr(merkle, "SPAN", span)
    monkeypatch.setattr(merkle, "WIDTH", 1 << span)
    monkeypatch.setattr(merkle, "STEP", step)
    monkeypatch.setattr(merkle, "BROADCAST_TREES", trees)
    rows = tree_rows(300)
    got = [tuple(r) for r in merkle.report(docs_of(spark, rows).repartition(3)).collect()]
    want = brute_manifest(rows)
    assert sorted(map(str, got)) == sorted(map(str, want))
    changed = {r[0] for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None}
    assert changed and {r[0] for r in got if not r[6]} == changed


@pytest.mark.parametrize("rows", [[(5, "a", "en", "s", 1)], [(5, "a", "en", "s", 1), (6, "a", "de", "s", 1)],
                                  [(i, "a", None, "s", 1) for i in range(5)]])
def test_small_trees(spark, rows):
    assert sorted(map(str, map(tuple, merkle.report(docs_of(spark, rows)).collect()))) == sorted(map(str, brute_manifest(rows)))


def test_manifest_of_an_empty_table(spark):
    assert merkle.report(docs_of(spark, tree_rows(3)).limit(0)).count() == 0


def test_a_proof_fails_for_any_other_leaf(spark):
    rows = tree_rows(40)
    got = merkle.manifest(docs_of(spark, rows)).collect()
    for r in got:
        assert merkle.fold(r.leaf.encode(), r.proof.encode()).decode() == r.root
        assert merkle.fold(h(r.leaf).encode(), r.proof.encode()).decode() != r.root
