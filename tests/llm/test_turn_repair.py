from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from casework.llm import turn_repair as tr

SCHEMA = "conv_id long, turn long, role string, text string, place int, kind string, _k1 int"
WORD = re.compile(r"[^\x20\x09-\x0D]")


def harmed(rows):
    """The rows after damage by conversation, in the order of turn, role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        out = convs.setdefault(conv, [])
        show = lambda x: " " if x is None else str(x)
        harm = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if harm == 0:
            continue
        if harm == 1:
            text = ""
        if harm == 2:
            text = re.sub("[.!?]", "", text)
        if harm == 4:
            role = "user"
        out += [(turn, role, text)] * (2 if harm == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {conv: sorted(out, key=order) for conv, out in convs.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = WORD.findall(text)[-1:]
        out.append(
            "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """Least (cost, audit) and its lines, by a table of whole strings over all role sequences."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    best = {"": (0, "", ())}

    def put(table, state, value):
        if state is not None and (state not in table or value[:2] < table[state][:2]):
            table[state] = value

    def insertions(table):
        for _ in range(3):
            for state, (cost, audit, lines) in list(table.items()):
                for role in ("user", "assistant"):
                    put(table, step.get((state, role[0])), (cost + 3, audit + "I", (*lines, f"{role}:")))
        return table

    for (_, role, text), fault in zip(rows, found):
        after = {}
        for state, (cost, audit, lines) in insertions(best).items():
            put(after, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 if fault == "truncated" else 0
            put(after, step.get((state, role[:1])), (cost + late, audit + "K", (*lines, f"{role}:{text}")))
            for new in ("user", "assistant"):
                put(after, step.get((state, new[0])), (cost + late + 3, audit + "R", (*lines, f"{new}:{text}")))
        best = after
    ends = insertions(best)
    return min((ends[s] for s in ("", "a") if s in ends), key=lambda v: v[:2])


def brute(rows):
    out = {}
    for conv, told in harmed(rows).items():
        found = faults(told)
        turns = [t for t, _, _ in told if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(told, told[1:])]
        cost, audit, lines = cheapest(told, found)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")))
        out[conv] = (*counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, digest)
    return out


def told(rng, conv, n):
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "usher", None]
    texts = ["Yes.", "Yes.", "No", "Why?", "  \n", "", None, "a ", "end. \n", "Größe!", "x" * 40]
    return [
        (conv, rng.choice([t, t, t, t + 3, None]), rng.choice(roles), rng.choice(texts)) for t in range(n)
    ]


def conversation_rows():
    """Nulls in every column, equal turns, repeated rows, gaps, and a hot conversation."""
    rng = random.Random(9)
    rows = [r for conv in range(150) for r in told(rng, conv, rng.randint(1, 9))]
    rows += told(rng, 1000, 400) + told(rng, None, 6) + [(2000, 1, "user", "Hm.")] * 30
    rows += [(2001, 7, r, f"text {i}.") for i, r in enumerate(["user", "assistant"] * 20)]
    rows += [(3000 + i, None, None, None) for i in range(40)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(3)


def by_conv(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("parts", ["1", "23"])
def test_equals_brute_force(spark, monkeypatch, parts):
    rows = conversation_rows()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = tr.repair_report(frame(spark, rows))
        assert got.columns == [
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
        ]
        assert by_conv(got) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repaired_text_in_pieces(spark):
    rng = random.Random(4)
    rows = told(rng, 1, 5) + [(2, t, "user" if t % 2 else "assistant", "word " * 9_000 + f"{t}.") for t in range(60)]
    rows += [(3, 0, "user", "only one.")]
    report, texts = tr.repaired(frame(spark, rows))
    want, lines = brute(rows), {}
    for r in sorted(texts.collect(), key=lambda r: (r.part, r.place)):
        lines.setdefault(r.conv_id, ([], []))
        lines[r.conv_id][0].append(r.audit)
        lines[r.conv_id][1].extend([r.text] if r.text else [])
    assert {r.conv_id: tuple(r)[1:] for r in report.collect()} == {c: v[:6] for c, v in want.items()}
    for conv, (audit, text) in lines.items():
        assert ("".join(audit), hashlib.sha256("\n".join(text).encode()).hexdigest()) == want[conv][6:]
    assert len(lines[2][1]) > 1


def enumerated(classes, limit=3):
    """Least (cost, audit) by trying every string of edits."""
    best = None
    inserts = ["I" * n for n in range(limit)]
    for choice in itertools.product(*([[i + e for i in inserts for e in "KRD"]] * len(classes))):
        for tail in inserts:
            roles, cost = "", 0
            for edits, (kind, initial) in zip(choice, classes):
                cost += 3 * edits.count("I")
                for e in edits:
                    wanted = "a" if roles[-1:] == "u" else "u"
                    if e == "I" or e == "R":
                        roles += wanted
                    elif e == "K":
                        roles += "sua?"[initial]
                last = edits[-1]
                cost += {"K": 0, "R": 3, "D": 4}[last] + (3 if kind == tr.CUT and last != "D" else 0)
                if kind in (tr.BLANK, tr.REPEATED) and last != "D":
                    cost = 10**6
            for _ in tail:
                roles += "a" if roles[-1:] == "u" else "u"
                cost += 3
            if cost < 10**6 and re.fullmatch("(s?(ua)+)?", roles):
                found = (cost, "".join(choice) + tail)
                best = found if best is None or found < best else best
    return best


@pytest.mark.parametrize("seed", range(12))
def test_program_equals_enumeration_whole_and_in_chunks(seed):
    rng = random.Random(seed)
    classes = [(rng.choice([tr.WHOLE, tr.WHOLE, tr.CUT, tr.BLANK]), rng.choice([0, 1, 1, 2, 2, 3])) for _ in range(rng.randint(0, 4))]
    want = enumerated(classes)

    def run(part, begins):
        out = tr.Conversation(1, tr.Automaton(), begins)
        for kind, initial in part:
            out.row(1, "sua?"[initial], kind, "x", 1, initial)
        return out

    whole = run(classes, (0,))
    cost, end = tr.close(whole.table()[0])
    assert (cost, "".join(i for i, _ in whole.changes(end, tr.CLOSING[end]))) == want
    cut = rng.randint(0, len(classes))
    values, came, audit = [(0, 0), None, None, None], [], ""
    for part in (classes[:cut], classes[cut:]):
        values, origin = tr.compose(values, run(part, (0, 1, 2, 3)).table())
        came.append(origin)
    cost, end = tr.close(values)
    closing = tr.CLOSING[end]
    for part, origin in zip((classes[cut:], classes[:cut]), reversed(came)):
        audit = "".join(i for i, _ in run(part, (origin[end],)).changes(end, closing)) + audit
        end, closing = origin[end], ""
    assert (cost, audit) == want


def test_spilled_rows_and_numbers_come_back(monkeypatch):
    monkeypatch.setattr(tr, "HELD", 64)
    monkeypatch.setattr(tr.Numbers, "BLOCK", 5)
    rows, numbers = tr.Rows(), tr.Numbers()
    for i in range(103):
        rows.push((i, "user", tr.WHOLE, "t" * i, 1, 1))
        numbers.push(i)
    assert [r[0] for r in rows] == list(range(103))
    assert list(numbers.backwards()) == list(range(102, -1, -1))


def test_empty_table(spark):
    assert tr.repair_report(frame(spark, []).limit(0)).collect() == []
