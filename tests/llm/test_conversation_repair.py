from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import pytest

from strata.llm import conversation_repair as repair
from strata.llm.conversation_repair import Weights

from tests.llm.helpers import WORD

SCHEMA = "conv_id long, turn long, role string, text string"
RIGHT = re.compile(r"(s?(ua)+)?\Z")


def prepared(rows):
    """Rows of each conversation in order, with their first fault."""
    whole = defaultdict(list)
    for conv, turn, role, text in rows:
        whole[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in whole.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, judged = set(), []
        for turn, role, text in own:
            fault = None
            if not WORD.search(text):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.rstrip("\t\n\x0b\x0c\r ")[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            judged.append((turn, role, text, fault))
        yield conv, judged


def all_repairs(rows, w):
    """Every way to edit the rows, inserting at most two rows at a place."""
    places = [["", "u", "a", "ua", "au"]] * (len(rows) + 1)
    for inserts in itertools.product(*places):
        options = []
        for _, role, text, fault in rows:
            extra = w.truncated if fault == "truncated" else 0
            ways = [(w.delete, "D", None, text)]
            if fault not in ("blank", "duplicate"):
                if role:
                    ways.append((w.keep + extra, "K", role, text))
                ways += [(w.rerole + extra, "R", new, text) for new in ("user", "assistant")]
            options.append(ways)
        for chosen in itertools.product(*options):
            cost, audit, said = 0, "", []
            for place in range(len(rows) + 1):
                for symbol in inserts[place]:
                    cost, audit = cost + w.insert, audit + "I"
                    said.append(({"u": "user", "a": "assistant"}[symbol], ""))
                if place < len(rows):
                    price, letter, role, text = chosen[place]
                    cost, audit = cost + price, audit + letter
                    if role is not None:
                        said.append((role, text))
            if RIGHT.match("".join(role[0] for role, _ in said)):
                yield cost, audit, said


def expected(rows, w=Weights()):
    told = {}
    for conv, own in prepared(rows):
        cost, audit, said = min(all_repairs(own, w))
        turns = [turn for turn, *_ in own if turn is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        faults = Counter(row[3] for row in own)
        initials = [row[1][:1] for row in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest()
        told[conv] = (
            (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal)
            + (cost, audit, sha),
            said,
        )
    return told


def made_up(seed, n=150):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut", "Why? ", "", " \n", "é…", "Ok?\t"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "s", "A"]
    rows = []
    for conv in range(n):
        for turn in range(rng.randint(1, 3)):
            turn = rng.choice([turn, turn, turn, turn + 2, None, 0])
            rows.append((conv, turn, rng.choice(roles[: rng.randint(3, 10)]), rng.choice(texts)))
    return rows


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("id", "copy", "fault", "audit", "place", "n"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.mark.parametrize(
    "weights",
    [
        Weights(),
        Weights(insert=1, delete=3, rerole=2, truncated=1),
        Weights(insert=1, delete=1, rerole=1, truncated=0),
        Weights(keep=1, insert=2, delete=5, rerole=4),
    ],
)
def test_against_all_repairs(spark, weights):
    rows = made_up(7, 50)
    wanted = expected(rows, weights)
    found = repair.repair(frame(spark, rows), weights).collect()
    assert {row.conv_id: tuple(row[n] for n in NAMES) for row in found} == {
        conv: told for conv, (told, _) in wanted.items()
    }


def test_repaired_rows(spark):
    rows, weights = made_up(8, 30), Weights(insert=1, delete=2)
    given = frame(spark, rows)
    repairs = repair.repair(given, weights)
    found = defaultdict(list)
    for row in repair.repaired_rows(given, repairs).collect():
        found[row.conv_id].append((row.place, row.role, row.text))
    for conv, (_, said) in expected(rows, weights).items():
        assert sorted(found[conv]) == [(n + 1, role, text) for n, (role, text) in enumerate(said)]


def test_odd_conversations(spark):
    long = "word. " * 30_000
    rows = [
        (None, 0, "user", "Hi."),
        (None, 1, "assistant", long),
        (1, None, None, None),
        (2, 3, "user", "Same."),
        (2, 3, "user", "Same."),
        (2, 3, "assistant", "Ok."),
    ]
    found = {row.conv_id: row for row in repair.repair(frame(spark, rows)).collect()}
    wanted = expected(rows)
    assert found.keys() == wanted.keys()
    for conv, (told, _) in wanted.items():
        assert tuple(found[conv][n] for n in NAMES) == told
    assert found[None].audit == "KK" and found[1].audit == "D"


def test_a_long_conversation_keeps_a_byte_for_each_row_and_stack(spark):
    parse = repair.Parse(Weights())
    for n in range(20_000):
        parse.feed(n, "user", f"Line {n}.", None)
    assert len(parse.steps) == 20_000 * 8 and len(parse.tops) <= 8
    gaps, *_, cost, audit, symbols, _ = parse.result()
    assert (gaps, cost, len(audit)) == (0, 10_000, 20_000)
    assert RIGHT.match(symbols.replace("-", ""))


def test_one_shuffle_of_the_texts(spark):
    plan = repair.repair(frame(spark, made_up(1, 5)))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("hashpartitioning") == 1


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    repairs = repair.repair(empty)
    assert repairs.count() == 0
    assert repair.repaired_rows(empty, repairs).count() == 0


def test_weights_are_checked():
    with pytest.raises(ValueError):
        Weights(insert=0)
