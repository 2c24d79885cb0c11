"""Search, clusters and conversation repair against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

VECTORS = "vec_id long, embedding array<float>, label int, score long, cluster int, copies long, rank int"


def vectors(spark, rows):
    """Vectors with extra columns whose names clash with results."""
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, 5) for i, v in rows], VECTORS)


def odd_vectors(rng, n=260, length=64):
    base = rng.normal(0, 0.2, (n, length)).astype(np.float32)
    base[50:90] = base[50]  # one vector many times
    base[90:120] = np.rint(base[90:120] * 4) / 4  # ties of scores
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100, base[100].tolist()), (300, base[7].tolist()), (300, base[8].tolist())]  # repeated rows and ids
    rows += [(301, None), (350, [math.nan] + [0.0] * (length - 1)), (302, [None] * length),
             (303, [math.inf] * length), (400, [0.0] * length), (450, [-0.0] * length)]
    rows += [(500, [0.5] * 7), (501, [0.25] * (length + 3)), (550, []), (None, base[3].tolist()),
             (600, [3e37] * length), (601, [-3e37] * length)]
    return rows


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


@pytest.mark.parametrize("block_rows,block_queries", [((2048, 65_536), 16_384), ((17, 40), 3)])
def test_search_finds_what_brute_force_finds(spark, block_rows, block_queries):
    from vitrine.llm.segment_search import search

    rows = odd_vectors(np.random.default_rng(1))
    got = {}
    for r in search(vectors(spark, rows), every=10, block_rows=block_rows, block_queries=block_queries).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if usable(v)]
    want = {}
    for q, a in {(q, tuple(a)) for q, a in whole if q is not None and q % 10 == 0}:
        scores = sorted((-max(min(sum(x * y for x, y in zip(a, b)), 2**63 - 1), -2**63), r is None, r or 0)
                        for r, b in whole if r != q)[:5]
        want.setdefault(q, []).extend((k + 1, None if no_id else r, -s) for k, (s, no_id, r) in enumerate(scores))
    def order(found):
        return sorted((k, s, r is None, r or 0) for k, r, s in found)
    assert got.keys() == want.keys()
    for q in want:
        assert order(got[q]) == order(want[q]), q


def test_bounds_never_fall_below_the_product():
    from vitrine.llm.segment_search import LEVELS, statistics

    rng = np.random.default_rng(2)
    for length in (1, 5, 64, 100):
        x, y = rng.integers(-300, 300, (40, length)), rng.integers(-300, 300, (50, length))
        finer = None
        for level in LEVELS:
            bound = statistics(x.astype(float), level) @ statistics(y.astype(float), level).T
            assert (bound >= x @ y.T).all()
            assert finer is None or (bound <= finer + 1e-6 * np.abs(finer)).all()
            finer = bound


def test_search_of_few_and_no_rows(spark):
    from vitrine.llm.segment_search import search

    assert search(vectors(spark, [])).count() == 0
    assert search(vectors(spark, [(50, [1.0])])).count() == 0
    assert [tuple(r) for r in search(vectors(spark, [(50, [1.0]), (51, [0.5])])).collect()] == [(50, 1, 51, 256 * 128)]


def clusters_by_brute_force(rows, rounds=3, count=16):
    kept = [(i, [max(-2**27, min(2**27, math.floor(64 * x))) for x in v])
            for i, v in rows if usable(v) and len(v) == 64]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in first[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for _, v in kept]
    for _ in range(rounds):
        found = assign()
        for k in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, found) if c == k]
            if own:
                centroids[k] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    sums = [sum(d for d, c in found if c == k) for k in range(len(centroids))]
    held = [s if s < 2**63 else None for s in [*sums, sum(sums)]]
    return sorted((i is None, i or 0, c, d, held[c], held[-1],
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
                  for (i, _), (d, c) in zip(kept, found))


@pytest.mark.parametrize("huge", [False, True])
def test_clusters_are_those_of_brute_force(spark, huge):
    from vitrine.llm.rotated_clusters import cluster_vectors

    rows = [r for r in odd_vectors(np.random.default_rng(3)) if huge or r[0] not in (600, 601)]
    got = cluster_vectors(vectors(spark, rows)).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, *tuple(r)[1:]) for r in got) == clusters_by_brute_force(rows)


def test_clusters_of_few_and_no_rows(spark):
    from vitrine.llm.rotated_clusters import cluster_vectors

    assert cluster_vectors(vectors(spark, [])).count() == 0
    rows = [(i, [float(i)] * 64) for i in range(3)]
    got = sorted(tuple(r) for r in cluster_vectors(vectors(spark, rows)).collect())
    assert [r[2] for r in got] == [0, 0, 0] and len({r[1] for r in got}) == 3


TURNS = "conv_id long, turn long, role string, text string, place long, codes string"


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repaired_by_hand(turns):
    """One conversation by a plain recursion over (turns read, state), least cost and then least letters."""
    turns = sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2], t[3][:64],
                                         hashlib.sha256(f"{len(t[2])}:{t[2]}{t[3]}".encode()).hexdigest()))
    seen, faults = set(), []
    for _, _, role, text in turns:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen
                      else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {}
    for i in range(len(turns), -1, -1):
        plain = {}
        for state in ("", "s", "u", "a"):
            options = []
            if i == len(turns):
                if state in ("", "a"):
                    options.append((0, "", ()))
            else:
                _, _, role, text = turns[i]
                cost, letters, lines = best[i + 1, state]
                options.append((cost + 4, "D" + letters, lines))
                if faults[i] not in ("blank", "duplicate"):
                    extra = 3 * (faults[i] == "truncated")
                    initial = role[:1]
                    if initial == after[state] or (state == "" and initial == "s"):
                        cost, letters, lines = best[i + 1, initial]
                        options.append((cost + extra, "K" + letters, (f"{role}:{text}", *lines)))
                    new = after[state]
                    cost, letters, lines = best[i + 1, new]
                    options.append((cost + 3 + extra, "R" + letters,
                                    ({"u": "user", "a": "assistant"}[new] + f":{text}", *lines)))
            plain[state] = options
        for _ in range(4):
            for state in ("a", "u", "s", ""):
                new = after[state]
                options = list(plain[state])
                if (i, new) in best:
                    cost, letters, lines = best[i, new]
                    options.append((cost + 3, "I" + letters, ({"u": "user:", "a": "assistant:"}[new], *lines)))
                if options:
                    best[i, state] = min(options)
    cost, letters, lines = best[0, ""]
    numbers = [t[1] for t in turns if t[1] is not None]
    initials = [t[2][:1] for t in turns]
    return (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *(faults.count(f) for f in (
        "blank", "duplicate", "truncated")), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(rng):
    texts = ["Yes.", "No!", "Why?", "cut short", "  \n", "", "Ends. \t", None, "same words", "."]
    roles = ["user", "assistant", "system", "tool", "", None, "usher", "User"]
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rng.randrange(0, 9)):
            rows.append((conv, turn * rng.choice((1, 1, 2)), rng.choice(roles[:2] if rng.random() < 0.7 else roles),
                         rng.choice(texts) if rng.random() < 0.6 else f"Turn {rng.random()}."))
    rows += [(500, None, "user", "No number."), (500, None, "user", "No number."), (500, 3, "assistant", "Yes.")]
    rows += [(501, t % 7, rng.choice(("user", "assistant")), rng.choice(texts)) for t in range(300)]  # ties
    rows += [(502, t, rng.choice(("user", "assistant")), f"Long {t}.") for t in range(700)]
    rows += [(503, 1, "user", "Long text! " * 30_000), (503, 2, "assistant", "x" * 200_000)]
    rows += [(504, 1, "user", "The same row.")] * 200
    return rows


@pytest.mark.parametrize("piece_bits", [2, 15])
def test_repairs_are_the_cheapest_and_least(spark, piece_bits):
    from vitrine.llm.turn_repair import damaged, repair_report

    rows = conversations(random.Random(5))
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS)
    got = {r["conv_id"]: tuple(r)[1:] for r in repair_report(damaged(table), table, piece_bits).collect()}
    by_conv = {}
    for r in damaged_by_hand(rows):
        by_conv.setdefault(r[0], []).append(r)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    want = {c: repaired_by_hand(by_conv[c]) if c in by_conv else empty for c in {r[0] for r in rows}}
    assert got.keys() == want.keys()
    for c in want:
        assert got[c] == want[c], c


def test_repaired_turns_are_the_rows_of_the_digest(spark):
    from vitrine.llm.turn_repair import Repair

    rows = [(1, 0, "user", "Hello."), (1, 1, "user", "Again."), (1, 2, "assistant", " "), (2, 0, "tool", "Data!")]
    repair = Repair(spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS))
    turns = [(r["conv_id"], r["role"], r["text"], r["edited"]) for r in repair.rows.orderBy("piece", "seq").collect()]
    assert turns == [(1, "user", "Hello.", False), (1, "assistant", "Again.", True),
                     ] and {r["conv_id"]: r["audit"] for r in repair.report.collect()} == {1: "KRD", 2: "D"}


def test_no_conversations(spark):
    from vitrine.llm.turn_repair import damaged, repair_report

    none = spark.createDataFrame([], TURNS)
    assert repair_report(damaged(none), none).count() == 0
