import hashlib
import re
import zlib

from utterflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """The trie by plain Python: every prefix of every rebuilt conversation."""
    own = {}
    for c, turn, role, text in rows:
        if c is None:
            continue
        own.setdefault(c, []).append((turn, role or "", text or ""))
    for c in own:
        own[c].sort(key=lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1], t[2]))
        own[c] = [(r, x) for _, r, x in own[c]]
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = own.get(base, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = {}
    for key, members in nodes.items():
        d = len(key)
        kids = [k for k in nodes if len(k) == d + 1 and k[:d] == key]
        subtree = [k for k in nodes if len(k) >= d and k[:d] == key]
        leaves = sum(1 for k in subtree if not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in nodes))
        saved = sum((len(nodes[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0) for k in subtree)
        ends = sorted(c for c in members if len(rebuilt[c]) == d)
        out[(min(members), d)] = (
            min(nodes[key[:-1]]) if d else None,
            len(members),
            len(kids),
            leaves,
            saved,
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        )
    return out


def run(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    result = prefix_trie.trie(table).collect()
    got = {
        (r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256)
        for r in result
    }
    assert len(got) == len(result)
    return got, result


ROWS = [
    (0, 0, "user", "hello there"), (0, 1, "assistant", "hi how are you"), (0, 2, "user", "fine"),
    (1, 0, "user", "hello there"), (1, 1, "assistant", "hi how are you"), (1, 2, "user", "bad day"),
    (2, 0, "user", "other start"), (2, 1, "assistant", "ok"),
    (3, None, "user", "null turn first"), (3, 0, None, None), (3, 0, None, None),
    (5, 0, "user", "hello there"),
    (20, 0, "user", "x y z"), (21, 0, "user", "a"), (22, 5, "user", "late"), (39, 1, "user", "b c"),
    (40, 0, "user", "hello there"), (41, 0, "user", "hello there"), (41, 1, "assistant", "hi how are you"),
    (None, 0, "user", "no conversation"),
    (60, 0, "user", "w " * 3000),
]


def test_trie_equals_brute_force(spark):
    got, result = run(spark, ROWS)
    assert got == brute(ROWS)
    tours = sorted(x for r in result for x in (r.tour_enter, r.tour_exit))
    assert tours == list(range(2 * len(result)))


def test_rebuilt_conversations_borrow_their_group_start(spark):
    rows = [(100, i, "user", f"t{i}") for i in range(5)] + [(100 + k, i, "user", f"own{k} {i}") for k in (1, 2, 3, 7) for i in range(5)]
    got, _ = run(spark, rows)
    assert got == brute(rows)


def test_copies_and_many_children(spark):
    rows = [(c, 0, "user", "same") for c in range(0, 400, 20)]
    rows += [(c, 1, "assistant", f"answer {c % 7}") for c in range(0, 400, 20)]
    got, _ = run(spark, rows)
    assert got == brute(rows)
    root = got[(0, 0)]
    assert root[1] == 20 and root[3] == 7


def test_empty_and_null_ids(spark):
    got, _ = run(spark, [])
    assert got == {}
    got, _ = run(spark, [(None, 0, "user", "x")])
    assert got == {}


def test_clashing_columns_are_ignored(spark):
    table = spark.createDataFrame(
        [(1, 0, "user", "a b", 9, "x"), (2, 0, "user", "a b", 9, "y")],
        "conv_id long, turn long, role string, text string, depth int, n_convs string",
    )
    rows = prefix_trie.trie(table).collect()
    assert {(r.conv_id, r.depth, r.n_convs) for r in rows} == set(
        (k[0], k[1], v[1]) for k, v in brute([(1, 0, "user", "a b"), (2, 0, "user", "a b")]).items()
    )


def test_sample_table(spark, sample):
    rows = [tuple(r) for r in sample("conversations").select("conv_id", "turn", "role", "text").collect()]
    got, _ = run(spark, rows)
    assert got == brute(rows)
