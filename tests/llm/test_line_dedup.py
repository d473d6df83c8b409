from __future__ import annotations

import random
import re

import pytest
from casework.llm import line_dedup

from pyspark.sql import functions as F

from .conftest import doc_rows, sentence


def brute(rows, least):
    """Texts without the lines of later copies, from every run of every length."""
    lines = [None if t is None else t.split("\n") for _, t in rows]
    words = lambda line: len(re.findall(r"[^\x20\x09-\x0D]+", line))
    first, drop = {}, [set() for _ in rows]
    order = sorted(range(len(rows)), key=lambda i: rows[i][0])
    for i in order:
        for a in range(len(lines[i] or [])):
            for b in range(a + 1, len(lines[i]) + 1):
                first.setdefault(tuple(lines[i][a:b]), (i, a))
    for i in order:
        for a in range(len(lines[i] or [])):
            for b in range(a + 1, len(lines[i]) + 1):
                run = tuple(lines[i][a:b])
                if sum(map(words, run)) >= least and first[run] != (i, a):
                    drop[i].update(range(a, b))
    return [
        None if text is None else "\n".join(x for k, x in enumerate(text) if k not in drop[i])
        for i, text in enumerate(lines)
    ]


def repeated_rows():
    rng = random.Random(11)
    pool = [sentence(rng, n) for n in (1, 1, 2, 3, 3, 4, 5, 9, 12, 60)] + ["", ""]
    rows = []
    for doc in range(40):
        text = [rng.choice(pool) if rng.random() < 0.6 else sentence(rng, rng.randint(1, 9)) for _ in range(rng.randint(1, 14))]
        rows.append((doc, "\n".join(text)))
    for doc, source in enumerate((3, 5, 5, 9), 40):
        rows.append((doc, rows[source][1]))
    rows.append((44, "\n".join([pool[3]] * 9)))
    return rows


@pytest.mark.parametrize("least", [1, 4, 8, 25])
def test_equals_brute_force(some_docs, least):
    rows = repeated_rows()
    got = {r.doc_id: r.text for r in line_dedup.deduped(some_docs(rows), least).collect()}
    assert got == {r[0]: t for r, t in zip(rows, brute(rows, least))}


def test_report_and_columns(some_docs):
    rows = repeated_rows()
    report = {r.doc_id: r for r in line_dedup.line_report(some_docs(rows)).collect()}
    for (doc, text), kept in zip(rows, brute(rows, line_dedup.WORDS)):
        r = report[doc]
        spans = [tuple(map(int, s.split("-"))) for s in r.deleted_spans.split()]
        assert r.text == kept
        assert r.n_lines == len(text.split("\n"))
        assert r.n_deleted == sum(b - a + 1 for a, b in spans)
    out = line_dedup.deduped(some_docs(rows))
    assert all(r.n_chars == len(r.text) for r in out.collect())


def test_edge_rows(docs, no_docs):
    out = line_dedup.deduped(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == len(doc_rows())
    text = {}
    for r in rows:
        text.setdefault(r.doc_id, []).append(r.text)
    assert text[60] == [None] and text[61] == [""]
    original = {r[0]: r[1] for r in doc_rows()}
    long_lines = [x for x in original[3].split("\n") if len(x.split()) >= line_dedup.WORDS]
    assert text[3] == [original[3]] and not any(x in text[62][0] for x in long_lines)
    assert text[65] == ["repeated row"] * 2
    assert line_dedup.deduped(no_docs).count() == 0
    assert line_dedup.line_report(no_docs).count() == 0


def test_array_equals_brute_force(some_docs):
    """Order, shared lines and longest earlier runs against sorted slices, with blocks of three suffixes."""
    rows = repeated_rows()
    lines = line_dedup._repeated_lines(some_docs(rows))
    table = sorted(lines.collect(), key=lambda r: r._place)
    assert [r._place for r in table] == list(range(len(table)))
    slices = [[(x._r1, x._r2) for x in table[r._place : r._place + r._left]] for r in table]
    array = line_dedup.suffix_array(lines)
    got = sorted(array.collect(), key=lambda r: r._sa)
    assert sorted(r._place for r in got) == list(range(len(table)))
    assert [slices[r._place] for r in got] == sorted(slices)

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    assert [r._lcp for r in got] == [0] + [common(slices[a._place], slices[b._place]) for a, b in zip(got, got[1:])]
    longest = [max((common(slices[q], slices[p]) for q in range(p)), default=0) for p in range(len(table))]
    for block in (3, line_dedup.BLOCK):
        found = {r._place: r._length for r in line_dedup.earlier_runs(array, block).collect()}
        assert found == {p: n for p, n in enumerate(longest) if n}


def test_long_copies(some_docs):
    """Long runs with nested repeats, where ranks need many levels and jumps."""
    rng = random.Random(5)
    base = [rng.choice("abcdef") * rng.randint(1, 2) for _ in range(70)]
    rows = [(d, "\n".join(base[rng.randint(0, 30) : rng.randint(40, 70)] + ["aa"] * rng.randint(0, 9))) for d in range(8)]
    for least in (1, 6):
        got = {r.doc_id: r.text for r in line_dedup.deduped(some_docs(rows), least).collect()}
        assert got == {r[0]: t for r, t in zip(rows, brute(rows, least))}


def test_intervals_across_blocks():
    """Scanning block by block from carried intervals equals one scan."""
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 30)
        places, lcp = rng.sample(range(n), n), [0] + [rng.choice((0, 1, 1, 2, 3, 5)) for _ in range(n - 1)]
        whole, parts, stack = line_dedup.scan(places, lcp, []), [], []
        for a in range(0, n, 4):
            parts += line_dedup.scan(places[a : a + 4], lcp[a : a + 4], list(stack))
            alone = []
            line_dedup.scan(places[a : a + 4], lcp[a : a + 4], alone)
            stack = line_dedup.carried(stack, line_dedup.frontier(alone), lcp[a])
            assert len({s for _, s in stack[1:]}) == len(stack[1:])
        assert parts == whole


def test_covered():
    assert line_dedup.covered([0, 1, 2, 5], [3, 5, 9, 2], [2, 1, 0, 1], 8) == [(0, 1)]
    assert line_dedup.covered([], [], [], 8) == []


def test_text_without_spaces(some_docs):
    """A repeated long line goes also where words are not spaced; a short one stays."""
    long = ["我们在这个项目中使用了许多不同的数据来源和工具", "これはとても長い文章なので繰り返しは一つだけ残ります", "ภาษาไทยไม่มีช่องว่างระหว่างคำในประโยคเดียวกัน"]
    rows = [(2 * k + n, f"{n}\n{line}\n谢谢") for k, line in enumerate(long) for n in (0, 1)]
    got = {r.doc_id: r.text for r in line_dedup.deduped(some_docs(rows)).collect()}
    assert got == {2 * k + n: "0\n" + line + "\n谢谢" if n == 0 else "1" for k, line in enumerate(long) for n in (0, 1)}


def test_words_of_lines(some_docs):
    """The short ways of counting equal the two patterns on lines of every kind."""
    rng = random.Random(4)
    parts = ["a", "bc", " ", "  ", "\t", "\r", "\x0b", "\x0c", "\u00a0", "é", "ж", "—", "谢谢", "ภาษา", "ក", "𠀀", "ｱ", "က"]
    lines = ["", " ", "a ", " a", "a b"] + ["".join(rng.choices(parts, k=rng.randint(1, 9))) for _ in range(400)]
    table = line_dedup._line_table(some_docs([(0, "\n".join(lines))]))
    pattern = some_docs([(0, "\n".join(lines))]).select(F.posexplode(F.split("text", "\n")).alias("_pos", "line")).select(
        "_pos",
        (F.regexp_count("line", F.lit(line_dedup.WORD)) + F.regexp_count("line", F.lit(line_dedup.UNSPACED))).alias("n"),
    )
    assert {(r._pos, r._words) for r in table.collect()} == {(r._pos, r.n) for r in pattern.collect()}
