"""Conversation repair, lattice hashing and the prefix tree against brute force on small rows."""

import itertools
import zlib
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from levyline.llm import (
    audit_path, conversation_repair, decontaminate, langid, lattice, line_dedup, mixing, ngram_join, prefix_trie, queries,
    urls,
)

TURNS = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    """(initial, fault) of rows (role, text) in order."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(SPACES)
        if not text.strip(SPACES):
            out.append((role[:1], "blank"))
        elif (role, text) in seen:
            out.append((role[:1], "duplicate"))
        else:
            out.append((role[:1], None if bare[-1] in ".!?" else "truncated"))
        seen.add((role, text))
    return out


def legal(roles):
    rest = roles[1:] if roles[:1] == "s" else roles
    return rest == "ua" * (len(rest) // 2) and (roles == "" or len(rest) > 0)


def all_audits(rows):
    """Every edit of every row, with up to two inserted turns at every place: the least (cost, audit, turns)."""
    best = None
    n = len(rows)
    judged = faults(rows)
    choices = [[("D", None, 3)] + ([] if f in ("blank", "duplicate") else [("K", role, 0), ("R", "user", 2), ("R", "assistant", 2)]) for (role, _), (_, f) in zip(rows, judged, strict=True)]
    places = [[()], [("user",), ("assistant",)], [("user", "assistant"), ("assistant", "user")]]
    for picked in itertools.product(*choices):
        base = sum(c for _, _, c in picked) + sum(e != "D" and f == "truncated" for (e, _, _), (_, f) in zip(picked, judged, strict=True))
        for inserted in itertools.product(sum(places, []), repeat=n + 1):
            cost = base + 2 * sum(map(len, inserted))
            if best is not None and cost > best[0]:
                continue
            out, audit = [], ""
            for i in range(n + 1):
                out += [(r, "") for r in inserted[i]]
                audit += "I" * len(inserted[i])
                if i < n:
                    edit, role, _ = picked[i]
                    audit += edit
                    if edit != "D":
                        out.append((role, rows[i][1]))
            if legal("".join(r[:1] or "?" for r, _ in out)) and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, out)
    return best


row = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", ""]), st.sampled_from(["a.", "b", " ", "c?  "]))


@settings(max_examples=60, deadline=None)
@given(st.lists(row, max_size=3))
def test_cheapest_audit_against_every_edit(rows):
    cost, audit, turns = all_audits(rows)
    judged = faults(rows)
    assert conversation_repair.cheapest(judged) == (cost, audit)
    steps, state = conversation_repair.applied(0, audit, [i for i, _ in judged], list(range(len(rows))))
    assert state in (0, 3)
    got = [(s["role"] or rows[s["digest"]][0], "" if s["digest"] is None else rows[s["digest"]][1]) for s in steps]
    assert got == turns


def plain_audit(judged):
    """The same program over whole texts."""
    none = (10**9, "")
    best = [(0, ""), none, none, none]

    def insert():
        for s in (0, 1, 3, 2):
            to = conversation_repair.NEXT[s]
            best[to] = min(best[to], (best[s][0] + 2, best[s][1] + "I"))

    insert()
    for initial, fault in judged:
        after = [(c + 3, a + "D") for c, a in best]
        if fault in (None, "truncated"):
            extra = fault == "truncated"
            for s, (c, a) in enumerate(best):
                kept, to = conversation_repair.KEEP.get((s, initial)), conversation_repair.NEXT[s]
                if kept is not None:
                    after[kept] = min(after[kept], (c + extra, a + "K"))
                after[to] = min(after[to], (c + 2 + extra, a + "R"))
        best[:] = after
        insert()
    return min(best[0], best[3])


many = st.lists(st.tuples(st.sampled_from("suat"), st.sampled_from([None, "blank", "duplicate", "truncated"])), max_size=60)


@settings(max_examples=150, deadline=None)
@given(many)
def test_audit_paths_with_good_and_with_colliding_hashes(judged):
    want = plain_audit(judged)
    assert conversation_repair.cheapest(judged) == want
    assert conversation_repair.cheapest(judged, prime=3) == want  # nearly all hashes collide


@settings(max_examples=100, deadline=None)
@given(st.text("DIKR", max_size=20), st.text("DIKR", max_size=20), st.integers(1, 50))
def test_order_of_paths(a, b, prime):
    root = audit_path.Step(None, "")

    def path(text):
        step = root
        for c in text:
            step = audit_path.Step(step, c, prime)
        return step

    x, y = path(a), path(b)
    assert audit_path.less(x, y) == (a < b) and audit_path.edits(x) == a
    assert audit_path.lifted(x, len(a) // 2).depth == len(a) // 2


@settings(max_examples=100, deadline=None)
@given(many, st.integers(1, 7))
def test_chained_pieces_give_the_whole_audit(judged, size):
    pieces = []
    for a in range(0, len(judged), size):
        rows = [{"conv_id": 1, "chunk": a, "turn": i, "initial": x, "digest": b"", "fault": f} for i, (x, f) in enumerate(judged[a:a + size])]
        pieces.append(conversation_repair._piece(rows, True))
    if pieces:
        done = conversation_repair.chained(pieces)
        assert (sum(c for _, c, _ in done), "".join(t for _, _, t in done)) == plain_audit(judged)


def talk(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], TURNS + ", chunk string")  # an extra column with an inner name


ODD = [
    (1, None, "user", "hi."), (1, 0, None, None), (1, 0, "user", "hi."), (1, 5, "assistant", "yes"), (1, 5, "assistant", "yes"),
    (2, 0, "user", "a."), (2, 1, "assistant", "b." * 100_000), (2, 2, "user", "c ."), (None, 0, "user", "x."), (None, None, "", ""),
    (3, None, "user", None), (4, 7, "system", "only."), (-101, 0, "user", "q?"), (-101, 1, "assistant", "r!"), (100, 0, "user", "a."), (100, 1, "assistant", "b."),
    (105, 0, "user", "a."), (105, 1, "assistant", "b."), (105, 2, "user", "c."), (111, 0, "user", "z."),
]


def expected_repair(rows):
    """conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest) by plain Python."""
    name = lambda x: " " if x is None else str(x)
    convs = {}
    for conv, turn, role, text in rows:
        held = convs.setdefault(conv, [])
        role, text = name(role), name(text)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        role = "user" if kind == 4 else role
        held += [] if kind == 0 else [(turn, role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        judged = faults([r[1:] for r in held])
        cost, audit = plain_audit(judged)
        steps, _ = conversation_repair.applied(0, audit, [i for i, _ in judged], list(range(len(held))))
        lines = [f"{s['role'] or held[s['digest']][1]}:{'' if s['digest'] is None else held[s['digest']][2]}" for s in steps]
        turns = [t for t, _, _ in held if t is not None]
        count = lambda kind: sum(f == kind for _, f in judged)
        illegal = sum(x + y not in ("su", "ua", "au") for (x, _), (y, _) in zip(judged, judged[1:], strict=False))
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, count("blank"), count("duplicate"), count("truncated"), illegal,
            cost, audit, sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def repaired(spark, rows, **options):
    damaged = conversation_repair.damaged(talk(spark, rows))
    audits, turns = conversation_repair.repair(damaged, **options)
    texts = {}
    for r in sorted(turns.collect(), key=lambda r: (r.chunk, r.pos)):
        texts.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, sha256("\n".join(texts.get(r.conv_id, [])).encode()).hexdigest())
        for r in audits.collect()
    }


@pytest.mark.parametrize("bits", [1, 2, 12])
def test_repair_of_odd_and_long_conversations(spark, bits):
    rng = np.random.default_rng(5)
    long = [(7, int(t), str(rng.choice(["system", "user", "assistant"])), str(rng.choice(["a.", "b", " ", f"{t}?"]))) for t in rng.integers(0, 150, 200)]
    want = {c: v for c, v in expected_repair(ODD + long).items()}
    got = repaired(spark, ODD + long, chunk_bits=bits)
    none = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    assert {c: got.get(c, none) for c in want} == want


def test_repair_of_nothing(spark):
    assert repaired(spark, []) == {}


def test_every_conversation_comes_out(spark, sf):
    got = queries.op11_audit_repair(spark, sf)
    assert got.count() == queries.table(spark, sf, "conversations").select("conv_id").distinct().count()


def expected_trie(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn, role or "", text or ""))
    for held in convs.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    built = {}
    for c, held in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        built[c] = tuple(r[1:] for r in convs.get(base, [])[:h] + held[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    out = set()
    for path, own in members.items():
        below = [p for p in members if p[:len(path)] == path]
        parents = [p for p in members if len(p) == len(path) + 1 and p[:-1] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[:-1] == p for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(str(c) for c in sorted(own) if len(built[c]) == len(path))
        out.add((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), len(parents), leaves, saved, sha256(ends.encode()).hexdigest()))
    return out


@pytest.mark.parametrize("height", [2, 3, 32])
def test_trie_against_brute_force(spark, height):
    rng = np.random.default_rng(13)
    deep = [(c, t, "user", "same" if t < 20 + c % 3 else f"{c}") for c in (300, 301, 302, 399) for t in range(25)]
    some = [(int(c), int(t), str(rng.choice(["user", "assistant"])), str(rng.choice(["a", "bb"]))) for c in rng.integers(500, 720, 60) for t in range(rng.integers(1, 5))]
    rows = ODD + deep + some
    turns, lengths = prefix_trie.shared_heads(prefix_trie.light(talk(spark, rows)))
    got = [tuple(r) for r in prefix_trie.nodes(turns, lengths, height=height).collect()]
    assert len(got) == len(set(got)) and set(got) == expected_trie(rows)


def test_trie_of_nothing(spark):
    turns, lengths = prefix_trie.shared_heads(prefix_trie.light(talk(spark, [])))
    assert prefix_trie.nodes(turns, lengths).collect() == []


def test_lattice_points_are_the_nearest():
    rng = np.random.default_rng(1)
    assert len(lattice.ROOTS) == 240 and np.allclose((lattice.ROOTS**2).sum(axis=1), 2)
    x = rng.normal(size=(50, 1, 8)) * 2
    own = lattice.points(x)[:, 0, 0] / 2
    whole = np.allclose(own * 2, np.rint(own * 2)) and (np.rint(own.sum(axis=1)) % 2 == 0).all()
    kinds = {tuple(np.unique(np.mod(p, 1))) for p in own}
    assert whole and kinds <= {(0.0,), (0.5,)}
    # no neighbour of the nearest point is nearer, and the probes are the nearest neighbours
    far = ((x[:, 0, None] - (own[:, None] + lattice.ROOTS)) ** 2).sum(axis=2)
    assert (((x[:, 0] - own) ** 2).sum(axis=1) <= far.min(axis=1) + 1e-9).all()
    probes = lattice.points(x)[:, 1:, 0] / 2
    assert np.allclose(((x - probes) ** 2).sum(axis=2).max(axis=1), np.sort(far, axis=1)[:, lattice.PROBES - 1])


def expected_links(rows, least=lattice.LEAST):
    """vec_id: (n_links, component) by all pairs."""
    ok = lambda v: v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    out = []
    for i, (vec_id, vector, label) in enumerate(rows):
        near = []
        if label is not None and ok(vector):
            for j, (_, other, their) in enumerate(rows):
                if i != j and their == label and ok(other) and len(other) == len(vector):
                    a, b = np.array(vector, float), np.array(other, float)
                    a, b = a / np.abs(a).max(), b / np.abs(b).max()
                    if a @ b / np.sqrt((a @ a) * (b @ b)) >= least:
                        near.append(j)
        out.append(near)
    root = list(range(len(rows)))
    for _ in rows:
        for i, near in enumerate(out):
            low = min([root[i], *(root[j] for j in near)])
            for j in (i, *near):
                root[j] = low
    ids = [r[0] for r in rows]
    lows = {k: min((ids[i] for i in range(len(rows)) if root[i] == k and ids[i] is not None), default=None) for k in set(root)}
    return sorted(((ids[i], len(out[i]), lows[root[i]], ids[i] is not None and ids[i] == lows[root[i]]) for i in range(len(rows))), key=repr)


def near_copies(rng, centre, n, noise):
    v = centre + rng.normal(size=(n, len(centre))) * noise / np.sqrt(len(centre))
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).tolist()


@pytest.mark.parametrize("block", [8, 1024])
def test_lattice_links_against_all_pairs(spark, block):
    rng = np.random.default_rng(12)
    centre = rng.normal(size=24)
    centre /= np.linalg.norm(centre)
    vectors = near_copies(rng, centre, 40, 0.2) + near_copies(rng, -centre, 30, 0.1) + rng.normal(size=(60, 24)).tolist() + [centre.tolist()] * 25
    rows = [(1000 - i, v, i % 2) for i, v in enumerate(vectors)]
    rows += [(5, None, 0), (6, [0.0] * 24, 0), (7, [None] * 24, 0), (8, [float("nan")] * 24, 0), (9, centre.tolist(), None), (None, centre.tolist(), 1)]
    rows += [(10, [1e300, 1e300], 0), (11, [1e-300, 1.1e-300], 0), (12, [], 0), (13, [float("inf"), 1.0], 0), (14, [1.0, -1.0], 0), (15, [-0.0, 1.0], 1), (16, [0.0, 1.0], 1)]
    rows += [rows[0], rows[0], (rows[1][0], rows[2][1], 0)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, embedding array<double>, label int, cell string, node string")
    got = sorted((tuple(r) for r in lattice.near_duplicates(df, block=block).collect()), key=repr)
    assert got == expected_links(rows)


def test_lattice_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert lattice.near_duplicates(df).collect() == []


def test_pairs_at_the_threshold_are_found():
    """2,000 pairs at a cosine of just 0.93: all but a few in 1,000 meet in some cell and pass the signs."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.normal(size=(2000, 64))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.93 * x + np.sqrt(1 - 0.93**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    for blocks in (1, 2):
        tables, label = lattice.tables_for(blocks), np.zeros(2000, np.int64)
        table, _ = lattice.meet_first(lattice.cells(x, label, blocks, tables), lattice.cells(y, label, blocks, tables))
        signs = [lattice.sketches(v, blocks, tables) for v in (x, y)]
        far = np.bitwise_count(signs[0] ^ signs[1]).sum(axis=1)
        assert ((table < tables) & (far <= lattice.FAR)).mean() >= 0.997
        assert tables <= 16


INNER = (
    "key copies alike times time tie size base p source_ open nth own lost l_own l_open n_lines n_lost family block rep n h1 h2 number root node "
    "label cell posting tokens a b side kept_key first place target taken id text_ lang_ lang_pred score segment item_id edits"
).split()


def test_inner_names_as_extra_columns(spark):
    """Every stage and operator that gives back the rows of a user leaves columns of any name as they are."""
    texts = ["\n".join(f"a line of text number {j} in document {i // 2}" for j in range(4)) for i in range(6)] + [None, ""]
    names = ["doc_id", "text", "source", "lang", *INNER, "with.dot"]
    rows = [(i, t, "s", "en", *(f"{n}-{i}" for n in [*INNER, "with.dot"])) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ", ".join(f"`{n}` " + ("long" if n == "doc_id" else "string") for n in names))
    benchmark = spark.createDataFrame([(1, "nothing of this kind stands in any of the texts")], "item_id long, text string")
    stages = {
        "mix": mixing.repeated(docs), "copies": ngram_join.one_per_component(docs), "lines": line_dedup.without_repeats(docs),
        "leaks": decontaminate.without_leaks(docs, benchmark), "language": langid.accepted(docs),
    }
    for stage, out in stages.items():
        added = {"n_lines", "n_lost"} if stage == "lines" else set()
        assert set(out.columns) == set(names) and len(out.columns) == len(names), stage
        got = out.collect()
        assert got, stage
        for r in got:
            assert all(r[n] == f"{n}-{r.doc_id}" for n in [*INNER, "with.dot"] if n not in added), stage


def test_lexical_features_decide_where_suffixes_do_not(spark):
    """One suffix for all: blocked URLs have many digits and parameters, allowed ones words. Unlabelled URLs of both kinds follow."""
    rng = np.random.default_rng(4)
    rules = (urls.Rule("block", "net/b/"), urls.Rule("allow", "net/a/"))

    def url(kind, folder):
        word = lambda letters, n: "".join(rng.choice(list(letters), n))
        tail = word("0123456789abcdef", 24) + "?" + "&".join(f"p{i}={word('0123456789', 6)}" for i in range(rng.integers(2, 6)))
        return f"http://h{rng.integers(10**6)}.site.net/{folder}/" + (tail if kind else word("aeioulmnrst", int(rng.integers(4, 30))))

    kinds = rng.integers(0, 2, 900)
    rows = [(i, url(k, ("x" if i >= 600 else "b" if k else "a"))) for i, k in enumerate(kinds.tolist())]
    got = {r.page_id: r for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    open_rows = [i for i, _ in rows if i >= 600]
    assert np.mean([(got[i].verdict == "block") == bool(kinds[i]) for i in open_rows]) >= 0.95
