"""Words that give entities away: copies, places and shapes."""

import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from hazardlens.llm import privacy
from tests.llm.cases import ROWS, docs, empty, order, prose
from tests.llm.test_text import PLAIN, base_by_hand


def told(spark, rows):
    """The words marked in each document."""
    found = {}
    for r in privacy.report(docs(spark, rows)).collect():
        text = {row[0]: row[1] for row in rows}[r.doc_id]
        places = re.findall(r"term:(\d+):(\d+)", r.spans)
        found[r.doc_id] = [text[int(a) : int(b)] for a, b in places]
    return found


def other(count):
    return [(i, f"{prose(i, 30)} nothing {i}x here", "en", "a", 0) for i in range(count)]


def test_a_passage_copied_many_times_hides_nothing(spark):
    rows = other(60)
    rows += [(100 + i, f"{prose(i, 5)} contact Zebulon at zeb@corp.org", "en", "a", 0) for i in range(3)]
    copies = [(200 + i, *rows[60][1:]) for i in range(200)]
    alone, many = told(spark, rows), told(spark, rows + copies)
    assert "Zebulon" in alone[101] and many[101] == alone[101]
    assert many[100] == alone[100] and all(many[200 + i] == alone[100] for i in range(200))


def test_terms_are_marked_in_whole_texts_and_without_the_address(spark):
    far = prose(1, 60)
    rows = other(60)
    rows += [(100 + i, f"Ng b{i}c said {far} K9x {far} {i} to ng@corp.org now", "en", "a", 0) for i in range(4)]
    rows += [(300, "K9x was seen; Ng, too, and NG again", "en", "a", 0)]
    found = told(spark, rows)
    assert {"Ng", "K9x"} <= set(found[102])
    assert found[300] == ["K9x", "Ng", "NG"]
    assert not any(found[i] for i in range(60))
    clean = {r.doc_id: r.text for r in privacy.sanitise(docs(spark, rows)).collect()}
    assert not re.search("K9x|Ng|NG", clean[300]) and "K9x" not in clean[101]


# --- brute force ----------------------------------------------------------------

WORD = r"[^\W_]+"


def given_by_hand(rows, share=0.8, support=2):
    """The terms that give an entity away, each entity with each term of all different texts."""
    texts = {r[1] or "" for r in rows}
    found = {t: [(k, t[a:b].lower(), (t[max(0, a - 81) : a], t[b : b + 81])) for k, a, b in base_by_hand(t)] for t in texts}
    said = {t: set(re.findall(WORD, blanked_by_hand(t).lower())) for t in texts}
    total, out = len(texts), set()
    entities = {(k, v) for own in found.values() for k, v, _ in own}
    of_term = Counter(w for own in said.values() for w in own)
    for entity in entities:
        holds = {t: min(c for *e, c in own if tuple(e) == entity) for t, own in found.items() if any(tuple(e) == entity for *e, _ in own)}
        for word in {w for t in holds for w in said[t]}:
            both = [t for t in holds if word in said[t]]
            if len({holds[t] for t in both}) < support or len(holds) == total:
                continue
            given = math.log2(len(both) * total / of_term[word] / len(holds)) / math.log2(total / len(holds))
            if min(1.0, given) >= share:
                out.add(word)
    return out


def blanked_by_hand(text):
    for kind in PLAIN:
        for k, a, b in base_by_hand(text):
            if k == kind:
                text = text[:a] + " " * (b - a) + text[b:]
    return text


def sanitised_by_hand(text, spans):
    out, at = [], 0
    islands = []
    for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1])):
        if islands and a < islands[-1][1]:
            islands[-1][1] = max(islands[-1][1], b)
        else:
            islands.append([a, b, kind])
    for a, b, kind in islands:
        out += [text[at:a], "" if kind == "term" else f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def mixed(seed, count):
    rng, rows = random.Random(seed), []
    people = [(f"Name{i}", f"Town{i}", f"p{i}@mail{i % 3}.org", f"10.0.{i}.7", f"+49 30 555 12{i:02d}") for i in range(9)]
    for i in range(count):
        words = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(3, 25))]
        for _ in range(rng.randrange(3)):
            who = rng.choice(people)
            own = [w for w in who if rng.random() < 0.7]
            at = rng.randrange(len(words))
            words[at:at] = own
        rows.append((i, rng.choice([" ", "\n", ", "]).join(words), "en", "a", 0))
    return rows + [(1000 + i, rows[i][1], "en", "b", 0) for i in range(0, count, 7)]


@pytest.mark.parametrize("seed", [1, 2])
def test_terms_and_marks_against_brute_force(spark, seed):
    rows = [*mixed(seed, 60), *[r for r in ROWS if len(r[1] or "") < 25_000]]
    table = docs(spark, rows)
    given = given_by_hand(rows)
    assert given
    want = []
    for r in rows:
        text = r[1] or ""
        marks = [("term", m.start(), m.end()) for m in re.finditer(WORD, blanked_by_hand(text)) if m.group().lower() in given]
        want.append((r[0], ",".join(f"{k}:{a}:{b}" for k, a, b in base_by_hand(text) + marks)))
    got = privacy.report(table).select("doc_id", "spans")
    assert order(tuple(r) for r in got.collect()) == order(want)
    spans = {(r[0], r[1]): [(int(a), int(b), k) for k, a, b in (s.split(":") for s in line.split(",") if s)] for r, (_, line) in zip(rows, want)}
    clean = [(r[0], None if r[1] is None else sanitised_by_hand(r[1], spans[r[0], r[1]])) for r in rows]
    clashing = table.withColumn("marks", F.lit(1)).withColumn("_digest", F.lit("x")).withColumn("row", F.lit(2))
    found = privacy.sanitise(clashing)
    assert found.columns == clashing.columns
    assert order(tuple(r) for r in found.select("doc_id", "text").collect()) == order(clean)
    assert privacy.sanitise(empty(spark)).collect() == []


def test_entities_of_one_list_are_one_class(spark):
    people = " ".join(f"n{i} at n{i}@list.org" for i in range(300))
    rows = other(40) + [(100 + i, f"{prose(i, 40)} {people} {prose(i + 3, 40)}", "en", "a", 0) for i in range(3)]
    table = docs(spark, rows)
    found = privacy.entities(privacy.looked_at(table)).cache()
    assert privacy._classes(found, 2).groupBy("kind", "value").count().count() <= 3
    assert {f"n{i}" for i in range(300)} <= set(told(spark, rows)[101])


def test_long_lists_take_time_in_proportion(spark):
    def seconds(n):
        text = " ".join(f"who{i} at a{i}@b{i}.org" for i in range(n)) + " word" * n
        rows = other(5) + [(100 + i, f"{prose(i, 30)} {text} {prose(i + 1, 30)}", "en", "a", 0) for i in range(2)]
        start = time.time()
        clean = {r.doc_id: r.text for r in privacy.sanitise(docs(spark, rows)).collect()}
        took = time.time() - start
        assert "@" not in clean[100] and clean[100].count("[EMAIL]") == n
        assert "who1 " not in clean[101]
        return took

    seconds(500)
    assert seconds(8_000) < seconds(2_000) * 4 + 10
