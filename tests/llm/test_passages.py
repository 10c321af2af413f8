"""Repeated passages against a brute force over lines and sentences, without ``chunks``."""

import random
import re

from tests.llm.conftest import SF
from tripkiln.llm import line_dedup as ld


def _pieces(line):
    """[sentence, space, sentence, ...] of a line of over 50 words."""
    return re.split(r"(?<=[.!?])([ \t]+)(?=\S)", line) if len(line.split()) > 50 else [line]


def _brute(rows):
    """Every adjacent pair of lines or sentences (blank lines do not count),
    and every one of over 50 words, that stands somewhere before goes."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        parts = [p for line in text.split("\n") for p in [*_pieces(line), "\n"]][:-1]
        full = [k for k, x in enumerate(parts) if x.strip()]
        gone = set()
        for k, a in enumerate(full):
            for n in (1, 2):
                if k + n > len(full) or (n == 1 and len(parts[a].split()) <= 50):
                    continue
                b = full[k + n - 1]
                first = seen.setdefault("".join(parts[a : b + 1]), (i, k + n))
                if first[0] != i or k >= first[1]:
                    gone |= {a, b}
        gone |= {k for a, b in zip(full, full[1:]) if {a, b} <= gone and "".join(parts[a + 1 : b]).count("\n") > 1 for k in range(a + 1, b)}
        lines, line, had = [], [], False
        for k, x in enumerate([*parts, "\n"]):
            if x == "\n":
                cut = "".join(line[:-1] if had and line and line[-1].isspace() else line)
                if cut or not had and not (k in gone and k - 1 in gone):
                    lines.append(cut)
                line, had = [], False
            elif k in gone:
                had = True
            elif not (x.isspace() and k - 1 in gone):
                line.append(x)
        out[i] = "\n".join(lines)
    return out


def _passages(df):
    return {r["doc_id"]: r["text"] for r in ld.drop_repeated_chunks(df).collect()}


def test_query_removes_whole_passages(spark, docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"]: r["text"] for r in ld.query(spark, SF).collect()} == _brute(rows)


def test_passages_of_2_to_10_lines(spark):
    rng = random.Random(3)
    passages = [[f"passage {n} copy {c} line {i}" for i in range(n)] for n in range(2, 11) for c in range(4)]
    rows, own = [], {}
    for d in range(120):
        lines, own[d] = [], []
        for k in range(rng.randint(1, 3)):
            mine = [f"document {d} line {k} {i}" for i in range(rng.randint(0, 4))]
            own[d] += mine
            lines += mine + rng.choice(passages) + rng.choice([[], [""], [f"own end {d} {k}"]])
        rows.append((d, "\n".join(lines)))
    got = _passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert got == _brute(rows)
    left = [x for t in got.values() for x in t.split("\n") if x.startswith("passage")]
    assert sorted(left) == sorted({x for _, t in rows for x in t.split("\n") if x.startswith("passage")})  # all once
    for d, mine in own.items():
        assert [x for x in got[d].split("\n") if x.startswith("document")] == mine


def test_cuts_leave_the_other_lines_as_they_were(spark):
    rows = [
        (0, "a\n\nb\nc"),
        (1, "x\na\n\nb\nc\ny"),
        (2, "a\n\nb\nc\n"),
        (3, "z\n\na\n\nb"),
        (4, "a\nb"),  # without the blank line: other bytes
        (5, "q\nq\nq"),  # a pair that overlaps its first place
        (6, "r\nr\nr\nr"),
        (7, "a\n"),
    ]
    assert _passages(spark.createDataFrame(rows, "doc_id long, text string")) == {
        0: "a\n\nb\nc", 1: "x\ny", 2: "", 3: "z\n", 4: "a\nb", 5: "q\nq\nq", 6: "r\nr", 7: "a\n",
    }


def test_passages_inside_long_lines(spark):
    def sentence(name, n=8):
        return " ".join(f"{name}{i}" for i in range(n)) + "."

    shared = " ".join(sentence(f"s{k}x") for k in range(7))  # 56 words
    one = sentence("alone", 60)  # a long sentence, no neighbour shared
    own = {d: [sentence(f"d{d}o{k}x", 20) for k in range(4)] for d in range(5)}
    rows = [
        (0, f"{own[0][0]} {shared} {own[0][1]}\nend 0\n{one}"),
        (1, f"{own[1][0]} {own[1][1]} {shared}\nend 1\n{one}\nafter 1"),
        (2, f"{shared}  {own[2][0]} {own[2][1]} "),
        (3, f"{shared}"),
        (4, f"{own[4][0]} {own[4][1]} {one} {own[4][2]} {own[4][3]}"),
    ]
    got = _passages(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == _brute(rows)
    assert got == {
        0: rows[0][1], 1: f"{own[1][0]} {own[1][1]}\nend 1\nafter 1", 2: f"{own[2][0]} {own[2][1]} ", 3: "",
        4: " ".join(own[4]),
    }
