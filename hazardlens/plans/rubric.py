"""Rule-based hazard scoring with a lexicon, evaluated inside Spark on whole texts.

A text is split into lower-case words once. Words of the lexicon are looked up as a set, which
costs far less per text than matching phrases; only texts with at least one of them are read
sentence by sentence. There a trie of phrases takes out what names no hazard (products, parts,
sayings), a denial takes out the hazards it governs, and a harmless class takes out the weak
words it explains. What is left of a sentence, or of two in a row for rules with several
groups, decides.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.constants import HARMLESS_CRITERIA, HAZARD_CRITERIA

# Words are letters and digits of any script; a comma is a word of its own. The second form of
# each is for Python's expressions.
NO_WORD_OR_COMMA = r"[^\p{L}\p{N},]+"
NO_WORD_OR_COMMA_PYTHON = r"(?:[^\w,]|_)+"
SENTENCE_END = r"[.!?;\n\r]+"


def terms(text: str) -> tuple[str, ...]:
    """Comma-separated words and phrases."""
    return tuple(term.strip() for term in text.split(","))


@dataclass(frozen=True)
class Rule:
    """A class of review, hit when a term of every group of ``all_of`` occurs.

    ``excuses`` of a harmless class are weak words that name no hazard in a sentence that hits it.
    """

    class_id: int
    name: str
    all_of: tuple[tuple[str, ...], ...]
    excuses: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rubric:
    """Hazard rules, harmless rules, phrases that name no hazard, and words that deny one.

    Between a denial and the hazard up to three ``fillers`` may stand; it reaches over "or",
    "and" and "nor" to further hazards. Words ``undenied`` name no harm by themselves.
    """

    hazards: tuple[Rule, ...]
    benign: tuple[Rule, ...] = ()
    harmless: tuple[str, ...] = ()
    denials: tuple[str, ...] = ()
    fillers: tuple[str, ...] = ()
    undenied: tuple[str, ...] = ()


_BLAZE = terms(
    "fire, fires, flame, flames, smoke, smoked, smokes, smoking, smoky, spark, sparks, sparked,"
    " sparking, burn, burns, burned, burnt, burning, explode, explodes, exploded, exploding,"
    " explosion"
)
_MELT = terms("melt, melts, melted, melting, deform, deforms, deformed, warp, warps, warped")
_SMELL = terms("smell, smells, smelled, smelly, odor, odors, odour, odours, stink, stinks, stench")
_ACHE = terms("pain, painful, hurt my, swelling, swollen")
_FIGURES = terms("burn, burned, burnt, burning, fire, smoke, smoking, choked, poison, poisonous")


def _rules(criteria: tuple[str, ...], *lexicon: tuple) -> tuple[Rule, ...]:
    rows = zip(criteria, lexicon, strict=True)
    return tuple(Rule(i, name, *row) for i, (name, row) in enumerate(rows, 1))


DEFAULT_RUBRIC = Rubric(
    hazards=_rules(
        HAZARD_CRITERIA,
        ((
            terms(
                "pain, painful, bleed, bleeds, bleeding, bled, blood, rash, rashes, allergy,"
                " allergies, allergic, swelling, swollen, swelled, poison, poisoned, poisoning,"
                " poisonous, injury, injuries, injured, blister, blisters, hurt my, cut my"
            ),
        ),),
        ((terms("choke, chokes, choked, choking, swallow, swallows, swallowed, swallowing"),),),
        ((
            _BLAZE
            + terms(
                "electric shock, electrical shock, shocked me, electrocuted, short circuit,"
                " short circuited"
            ),
        ),),
        ((
            terms(
                "hot to the touch, hot to touch, hot to hold, burning hot, scald, scalds, scalded,"
                " scalding"
            ),
        ),),
        ((_MELT, _BLAZE),),
        ((
            _SMELL + terms("fumes, fume, chemical, chemicals"),
            terms(
                "headache, headaches, nausea, nauseous, dizzy, dizziness, throat, cough, coughing,"
                " vomit, vomiting, eye irritation, eyes burn, eyes water, irritated eyes"
            ),
        ),),
        ((
            terms("food, drink, drinks, drinking, cooking, baking"),
            terms(
                "unsafe, not safe, toxic, rust, rusty, rusted, rusting, peel, peels, peeled,"
                " peeling, flakes, flaking, flaked"
            ),
        ),),
        ((
            terms("voltage, 110v, 120v, 220v, 230v, 240v"),
            _BLAZE + terms("fried, blew, blown, failed, failure, died"),
        ),),
        ((terms("burst, bursts, bursting, rupture, ruptured, ruptures, rupturing, shattered"),),),
    ),
    benign=_rules(
        HARMLESS_CRITERIA,
        ((
            terms(
                "broken, broke, poor quality, bad quality, cheap, fake, wrong item, wrong product,"
                " wrong size, wrong color, stopped working, not working, doesn t work, doesnt work"
            ),
        ), terms("pain, painful")),
        ((
            terms("damaged my, ruined my, scratched my"),
            terms("printer, phone, car, laptop"),
        ),),
        ((
            terms(
                "leak, leaks, leaked, leaking, refund, refunds, refunded, seller, return, returned"
            ),
        ), terms("pain, painful")),
        ((
            terms(
                "uncomfortable, discomfort, too tight, too small, too big, too narrow, runs small,"
                " digs into, break in, poor fit, bad fit"
            ),
        ), _ACHE),
        ((
            terms("scam, scammed, scammer, fraud, mislead, misleads, misleading, malware, virus, ripped off"),
        ), _ACHE + _FIGURES),
        ((terms("warm"),),),
        ((terms("overheat, overheats, overheated, overheating"),),),
        ((_MELT,),),
        ((_SMELL,),),
    ),
    harmless=terms(
        "fire pit, fire pits, fire truck, fire trucks, fire engine, fire engines, fire tablet,"
        " fire tablets, fire tv, fire stick, fire hd, fire kindle, fire phone, kindle fire, fire red,"
        " fire sale, fire alarm, fire alarms, fire extinguisher, fire extinguishers, fire starter,"
        " fire station, fire fighter, fire hose, fire proof, fire resistant, fire retardant,"
        " fire place, color of fire, colour of fire, camp fire, flame retardant, flame resistant,"
        " flame proof, flameless candle, smoke detector, smoke detectors, smoke alarm, smoke alarms,"
        " smoke colored, smoke coloured, smoke color, smoke grey, smoke gray, smoke machine,"
        " smoke free, smoked glass, smoked salmon, smoked paprika, smoked meat, smoking deal,"
        " smoking jacket, smoky eye, smoky quartz, smoky flavor, smoky grey, smoky gray, spark plug,"
        " spark plugs, spark joy, sparks joy, blood pressure, blood sugar, blood glucose,"
        " blood oxygen, blood orange, blood type, blood red, blood test, pain to, pain in the,"
        " pain relief, pain reliever, painful price, painful to look, painful to read,"
        " painful to watch, burn out, burns out, burned out, burnt out, burning out, burn through,"
        " burns through, burned through, burning through, burn calories, burn fat, burn cds,"
        " burn dvds, burn a cd, burn a dvd, screen burn, burning question, explosion of flavor,"
        " explosion of color, flavor explosion, exploded view, exploded diagram, choke valve,"
        " choke cable, choke point, hard to swallow, burst of flavor, burst of energy,"
        " burst of color, burst mode, rash guard, rash guards, rash decision, allergy season,"
        " allergy medicine, allergy test, allergy relief, colors bleed, color bleeds, ink bleeds,"
        " ink bleed, bleed through, bleeds through, bleeding edge, melts in my mouth,"
        " melts in your mouth, poison ivy, shocked me how, shocked me that"
    ),
    denials=terms(
        "no, not, never, without, nothing, none, nor, neither, didn t, doesn t, don t, isn t, wasn t,"
        " hasn t, haven t, won t, can t, cannot"
    ),
    fillers=terms(
        "a, an, any, the, even, ever, at all, been, be, get, got, getting, have, had, has, cause, caused,"
        " causing, give, gave, catch, caught, real, actual, visible, sign of, signs of, trace of,"
        " kind of, single, more, actually, really, me, my, on, too, so, was, were, is"
    ),
    undenied=terms(
        "food, drink, drinks, drinking, cooking, baking, unsafe, not safe, voltage, 110v, 120v, 220v,"
        " 230v, 240v, fried, blew, blown, failed, failure, died, chemical, chemicals"
    ),
)


def trie(phrases: Iterable[str]) -> str:
    """The phrases as one expression, a branch for each next word, longer ones first."""
    branches: dict[str, list[str]] = {}
    for phrase in phrases:
        first, _, rest = phrase.partition(" ")
        branches.setdefault(first, []).append(rest)
    out = []
    for first, rests in branches.items():
        longer = [rest for rest in rests if rest]
        after = f" {trie(longer)}" if longer else ""
        if after and "" in rests:
            after = f"(?:{after})?"
        out.append(first + after)
    return f"(?:{'|'.join(out)})"


def hazard_terms(rubric: Rubric) -> tuple[str, ...]:
    """Words and phrases that can be denied."""
    named = dict.fromkeys(t for rule in rubric.hazards for group in rule.all_of for t in group)
    return tuple(t for t in named if t not in rubric.undenied)


def rewrites(rubric: Rubric) -> list[tuple[str | None, str]]:
    """What is taken out of a sentence, step by step: an expression that the sentence must have,
    if any, and the one that is replaced by a blank mark. Words have single spaces around them."""
    steps: list[tuple[str | None, str]] = []
    if rubric.harmless:
        steps.append((None, f"(?: {trie(rubric.harmless)})+ "))
    if rubric.denials:
        hazard, filler = trie(hazard_terms(rubric)), f"(?: {trie(rubric.fillers)}){{0,3}}" if rubric.fillers else ""
        named = f"{filler} {hazard}"
        more = f"(?:(?: ,{named})*(?: ,)? (?:or|and|nor){named})*"
        steps.append((None, f" {trie(rubric.denials)}{named}{more} "))
    for rule in rubric.benign:
        if rule.excuses:
            steps += [(f" {trie(rule.all_of[0])} ", f"(?: {trie(rule.excuses)})+ ")]
    return steps


MARK = " _ "


def triggers(rules: tuple[Rule, ...]) -> tuple[str, ...]:
    """Words of which every hit needs one: the first groups, phrases by their longest word."""
    firsts = [term for rule in rules for term in rule.all_of[0]]
    return tuple(dict.fromkeys(max(term.split(), key=len) for term in firsts))


def _names(words: Iterable[str]) -> str:
    """An expression for the words at the start of a word, those with one first letter together."""
    by: dict[str, list[str]] = {}
    for word in dict.fromkeys(words):
        by.setdefault(word[0], []).append(re.escape(word[1:]))
    return rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(f'{re.escape(first)}(?:{"|".join(rests)})' for first, rests in by.items())})"


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` mentions it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spaced(sentence: Column) -> Column:
    """Words and commas of a sentence with single spaces around them."""
    words = F.regexp_replace(F.regexp_replace(sentence, NO_WORD_OR_COMMA, " "), " *, *", " , ")
    return F.concat(F.lit(" "), words, F.lit(" "))


def _without(needs: str | None, pattern: str) -> Callable[[Column], Column]:
    def step(sentence: Column) -> Column:
        out = F.regexp_replace(sentence, pattern, MARK)
        return out if needs is None else F.when(F.rlike(sentence, F.lit(needs)), out).otherwise(sentence)

    return step


def _has_all(patterns: list[str]) -> Callable[[Column], Column]:
    return lambda s: reduce(lambda a, b: a & b, [F.rlike(s, F.lit(p)) for p in patterns])


def _rewritten(sentence: Column, rubric: Rubric) -> Column:
    out = F.regexp_replace(_spaced(sentence), " +", " ")
    for needs, pattern in rewrites(rubric):
        out = _bind(out, _without(needs, pattern))
    return out


def _first_class(text: Column, rubric: Rubric, rules: tuple[Rule, ...]) -> Column:
    def chosen(sentences: Column) -> Column:
        after = F.concat(F.slice(sentences, F.lit(2), F.size(sentences)), F.array(F.lit("")))
        pairs = F.zip_with(sentences, after, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        result = F.lit(0)
        for rule in reversed(rules):
            where = sentences if len(rule.all_of) == 1 else pairs
            patterns = [f" {trie(group)} " for group in rule.all_of]
            hit = F.exists(where, _has_all(patterns))
            result = F.when(hit, rule.class_id).otherwise(result)
        return result

    # A sentence without a word of any rule has no hit, however it is rewritten.
    named = [max(term.split(), key=len) for rule in rules for group in rule.all_of for term in group]
    sentences = F.transform(
        F.split(F.lower(text), SENTENCE_END),
        lambda s: F.when(F.rlike(s, F.lit(_names(named))), _rewritten(s, rubric)).otherwise(""),
    )
    return _bind(sentences, chosen)


def _judged(text: Column, rubric: Rubric, rules: tuple[Rule, ...]) -> Column:
    candidate = F.rlike(F.lower(text), F.lit(_names(triggers(rules))))
    return F.when(candidate, _first_class(text, rubric, rules)).otherwise(0)


def hazard_class(text: Column, rubric: Rubric = DEFAULT_RUBRIC) -> Column:
    """Id of the first hazard rule that is hit, 0 when none is."""
    return _judged(text, rubric, rubric.hazards)


def hazard_label(text: Column, rubric: Rubric = DEFAULT_RUBRIC) -> Column:
    """1 when a hazard rule is hit, else 0; unclear reviews are 0."""
    return (hazard_class(text, rubric) > 0).cast("int")


def benign_class(text: Column, rubric: Rubric = DEFAULT_RUBRIC) -> Column:
    """Id of the first harmless rule, 0 for hazards and for reviews that hit none."""

    no_hazard = _judged(text, rubric, rubric.hazards) == 0
    return F.when(no_hazard, _judged(text, rubric, rubric.benign)).otherwise(0)


def python_scorer(rubric: Rubric = DEFAULT_RUBRIC) -> Callable[[], Callable[[list[str]], list[int]]]:
    """The same hazard rules as a scorer for ``score_batches``, made once per task."""
    steps, rules = rewrites(rubric), [rule.all_of for rule in rubric.hazards]

    def make() -> Callable[[list[str]], list[int]]:
        compiled = [(n and re.compile(n), re.compile(p)) for n, p in steps]
        groups = [[re.compile(f" {trie(group)} ") for group in rule] for rule in rules]

        def rewritten(sentence: str) -> str:
            words = re.sub(" *, *", " , ", re.sub(NO_WORD_OR_COMMA_PYTHON, " ", sentence))
            out = re.sub(" +", " ", f" {words} ")
            for needs, pattern in compiled:
                if needs is None or needs.search(out):
                    out = pattern.sub(MARK, out)
            return out

        def label(text: str) -> int:
            sentences = [rewritten(s) for s in re.split(SENTENCE_END, text.lower())]
            pairs = [a + b for a, b in zip(sentences, [*sentences[1:], ""], strict=True)]
            return int(any(
                any(all(p.search(s) for p in rule) for s in (sentences if len(rule) == 1 else pairs))
                for rule in groups
            ))

        return lambda texts: [label(text) for text in texts]

    return make


def instructions(rubric: Rubric = DEFAULT_RUBRIC) -> str:
    """The rubric as instructions for a model that answers with a JSON list of labels."""
    lines = ["Label every numbered review. Answer with a JSON array of 0 and 1 and nothing else."]
    lines += ["", "Label 1, when the review clearly reports:"]
    lines += [f"- {rule.name}" for rule in rubric.hazards]
    lines += ["", "Label 0, when the review reports only:"]
    lines += [f"- {rule.name}" for rule in rubric.benign]
    return "\n".join([*lines, "", "When in doubt, label 0."])
