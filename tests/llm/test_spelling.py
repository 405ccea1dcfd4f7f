import re
import zlib
from collections import Counter

from utterflow.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def lower(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    out = {}
    for w, n in words.items():
        near = [(o, m) for o, m in words.items() if one_edit(w, o)]
        form = None
        if near:
            best = max(m for _, m in near)
            if best >= 5 * n:
                form = min(o for o, m in near if m == best)
        out[w] = [form, None, n, len(near), words[form] if form else None]
    for w in out:
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        out[w][1] = root
    return {w: tuple(v) for w, v in out.items()}


def run(documents, rows):
    got = spelling.variants(documents(rows)).collect()
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got}


def test_variants_equal_brute_force(documents):
    rows = []
    for i in range(40):
        rows.append((i, "colour colour colour Colour colour " * 2 + "color neighbour"))
    for i in range(6):
        rows.append((100 + i, "color colr colour colours neighbor neighbour neighbours ÉCOLE école écolé"))
    rows += [(None, "colour Colour"), (200, None), (201, ""), (202, "x" * 50000)]
    got = run(documents, rows)
    assert got == brute(rows)
    assert got["colours"][0] == "colour"


def test_chains_follow_to_the_root(documents):
    rows = [(i, "abcdefgh") for i in range(5)]
    rows += [(100 + i, "abcdefgx") for i in range(30)]
    rows += [(200 + i, "abcdefxx") for i in range(200)]
    got = run(documents, rows)
    assert got == brute(rows)
    assert got["abcdefgh"][1] == "abcdefxx"


def test_ties_take_the_smallest_form(documents):
    rows = [(i, "abcdefg") for i in range(5)] + [(100 + i, "abcdefh abcdefi") for i in range(30)]
    got = run(documents, rows)
    assert got == brute(rows)
    assert got["abcdefg"][0] == "abcdefh"


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(empty).collect() == []
    clash = spark.createDataFrame(
        [(i, "letters " * 5, "w", 3) for i in range(2)], "doc_id long, text string, word string, n int"
    )
    rows = spelling.variants(clash).collect()
    assert [(r.word, r.n) for r in rows] == [("letters", 10)]


def test_sample_table(documents, sample):
    rows = [tuple(r) for r in sample("documents").select("doc_id", "text").collect()]
    got = spelling.variants(sample("documents")).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == brute(rows)
