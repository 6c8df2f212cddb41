"""Personal data in texts: fixed patterns, and what boosted trees recognise among generous candidates.

Everything on the way from text to result is Spark's own expressions. Spans come from splitting a text at a pattern and
adding up the lengths of the pieces. Generators propose spans with high recall, which may overlap each other: loose
addresses, loose runs of digits with separators, and the digit groups inside. A candidate is described by its
format (lengths, kinds of characters, groups, check digit) and context (characters and words around it). Gradient
boosted trees are trained on all candidates of all documents, labelled by whether a pattern
confirms them, and of drawn texts in other formats whose label is known; the trees become one expression. Candidates with
the same features are one weighted row, which the trees can't tell from so many, and a label's weights are scaled to a fixed
sum: the documents teach alike, few or many.
Calibration on held-back candidates picks the least probability above which nearly all are personal. What reaches it and overlaps no pattern's span, nor a better candidate, is
added.

A text takes time in proportion to its length: places are running sums over short pieces, a candidate is held only against
spans found by halving ordered lists, and its surroundings are read from blocks of the text.

Rows and edge cases: one row comes out per row that goes in. Null text counts as empty and has no spans. Rows are
independent of each other but for the model, so ids may be null or repeat. Of overlapping candidates the more
probable is taken, of equal ones the longer, then the one that starts first. If no probability reaches the precision asked for, nothing is added. Other columns are not read.
"""

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm.shared import stored, text_of

KINDS = ("email", "ip", "card", "phone")
ADDED = "private"
# The patterns asked for, written so that a failing start is given up at once.
_LOCAL = "[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for the pattern to be worth a try.
_HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
# The generators: loose addresses, loose numbers, and long digit groups by themselves.
_GENERATORS = (
    r"(?<![^\s@<>\"'()\[\]])[^\s@<>\"'()\[\]]{1,64}+(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[^\s@<>\"']{2,255}+",
    r"[+(]?[0-9](?:[\x20().\x2D/]{0,3}[0-9]){6,30}+",
    r"(?<![0-9])[0-9]{7,30}+(?![0-9])",
)
# No candidate is longer, nor meets more valid spans of a kind.
LONGEST = 330
CONTEXT = 24
# Characters of a block of text, and numbers that are added up at a time.
BLOCK, PIECE = 1024, 32
_HINT_WORDS = "phone|tel|call|fax|mobile|mail|contact|card|visa|account|iban|ip|host|addr|ssn|passport|name"

# Labelled texts; # stands for a digit, % for a letter. The first ones hold personal data.
_PERSONAL = (
    "call (###) ###-#### now", "tel ###-###-####.", "phone: ### ### ####", "fax ## ## ## ## ##", "mobile #### ######",
    "ring +## ### ### #### or", "tel. (0##) #### ####", "my phone is ###.###.####", "card #### #### #### ####",
    "visa ####-####-####-#### exp", "mail %%%%.%%%%% (at) %%%%%%.com", "contact %%%%% [at] %%%%.org", "ssn ###-##-####",
    "account #### #### #### ####", "write to %%%%%%@%%%%%",
)
_OTHER = (
    "on ####-##-## at", "from ##/##/#### to", "version #.#.# of ####-##-##", "order ########## of", "pages ###-### in ####",
    "price ####.## and ###", "id ######## row", "took ############# ms", "isbn ###-#-##-######-#", "ratio #.######## of",
    "build ####.##.##.####", "total ################ units", "sum ########### of", "table #### #### rows", "(####) ####-#### lines",
    "at ##.##.#### ##", "%%%%% ################ %%%%%", "%%%% ################$$$", "range ####-####", "commit ########",
)
DRAWN = 150
# What the documents' candidates of a label weigh at most, all together; a drawn candidate weighs 1.
WEIGHT = 8000
# Limits that a feature may be split at: more than the whole numbers that it takes, so that the trees try each of them. With
# fewer, Spark would choose them from a sample of the rows.
LIMITS = 512
TREES, DEPTH = 12, 4
PRECISION = 0.98
_SPAN = "array<struct<s:int,e:int,v:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it stands in ``body`` or in what is done per element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """For each number of a list, which is not empty, the sum of those before it.

    Adding to a list copies it, so sums are taken over short pieces, then over the sums of pieces, twice.
    """
    def short(piece: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(piece, start, lambda done, x: F.struct(
            (done["sum"] + x).alias("sum"), F.concat(done["before"], F.array(done["sum"])).alias("before")))

    def level(values: Column, sums_of: Callable[[Column], Column]) -> Column:
        def cut(v: Column) -> Column:
            last = F.floor((F.size(v) - 1) / PIECE).cast("int")
            return F.transform(F.sequence(F.lit(0), last), lambda k: short(F.slice(v, k * PIECE + 1, PIECE)))

        def joined(parts: Column) -> Column:
            offsets = sums_of(F.transform(parts, lambda part: part["sum"]))
            return F.flatten(F.zip_with(parts, offsets, lambda part, o: F.transform(part["before"], lambda x: x + o)))

        return _let(_let(values, cut), joined)

    return level(lengths, lambda sums: level(sums, lambda few: short(few)["before"]))


def _spans(text: Column, pattern: str) -> Column:
    """Start, end and text of all matches, in code points, in time in proportion to the text."""
    pieces = F.transform(F.split(text, pattern, -1), F.length)
    both = F.struct(pieces.alias("between"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))

    def placed(x: Column) -> Column:
        steps = F.zip_with(x["between"], x["found"], lambda p, m: p + F.coalesce(F.length(m), F.lit(0)))
        starts = F.zip_with(_running(steps), x["between"], lambda before, p: before + p)
        spans = F.zip_with(F.slice(starts, 1, F.size(x["found"])), x["found"], lambda s, m: F.struct(
            s.alias("s"), (s + F.length(m)).alias("e"), m.alias("v")))
        return F.when(F.size(x["found"]) > 0, spans).otherwise(F.array().cast(_SPAN))

    return _let(both, placed)


def _first_beyond(spans: Column, field: str, value: Column) -> Column:
    """Number, from 0, of the first span whose ``field`` is above ``value``; the spans are in that order."""
    start = F.struct(F.lit(0).alias("low"), F.size(spans).alias("high"))

    def halved(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        open_, beyond = at["low"] < at["high"], F.get(spans, middle)[field] > value
        return F.struct(F.when(open_ & ~beyond, middle + 1).otherwise(at["low"]).alias("low"),
                        F.when(open_ & beyond, middle).otherwise(at["high"]).alias("high"))

    return F.aggregate(F.sequence(F.lit(1), F.length(F.bin(F.size(spans)))), start, halved, lambda at: at["low"])


def _valid(kind: str, value: Column) -> Column:
    """Whether a match counts."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    return {
        "email": F.lit(True),
        "ip": value.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"),
        "card": F.length(digits).between(13, 19) & F.call_function("luhn_check", digits),
        "phone": F.length(digits).between(9, 15),
    }[kind]


def _of_kind(kind: str, span: Column) -> Column:
    return _valid(kind, span["v"])


def _named(kind: str, span: Column) -> Column:
    return F.struct(F.lit(kind).alias("k"), span["s"].alias("s"), span["e"].alias("e"))


def _with_patterns(rows: DataFrame) -> DataFrame:
    """A column of valid spans for each kind."""
    text, nothing = F.col("text"), F.array().cast(_SPAN)
    for kind, pattern in _PATTERNS.items():
        there = text.contains(_HINTS[kind]) if _HINTS[kind] else text.rlike("[0-9]")
        spans = F.filter(_spans(text, pattern), partial(_of_kind, kind))
        rows = rows.withColumn(kind, F.when(there, spans).otherwise(nothing))
    return rows


def _overlaps(a: Column, b: Column) -> Column:
    return (a["s"] < b["e"]) & (b["s"] < a["e"])


class _Around:
    """Characters around spans, from the blocks of a text: finding a place in a text would go through it from its start."""

    def __init__(self, blocks: Column) -> None:
        self.blocks = blocks

    def _block(self, place: Column) -> Column:
        return F.coalesce(F.get(self.blocks, F.floor(place / BLOCK).cast("int")), F.lit(""))

    def at(self, place: Column) -> Column:
        """The character at a place; empty before the first and after the last."""
        return F.when(place >= 0, F.substring(self._block(place), place % BLOCK + 1, F.lit(1))).otherwise("")

    def before(self, place: Column, width: int) -> Column:
        """As many characters before a place."""
        behind = F.greatest(F.floor(place / BLOCK).cast("int") - 1, F.lit(0)) * BLOCK
        two = F.concat(F.when(place >= BLOCK, self._block(behind)).otherwise(""), self._block(place))
        here = place - behind
        return F.substring(two, F.greatest(here - width, F.lit(0)) + 1, F.least(here, F.lit(width)))


FEATURES = ("length", "digits", "letters", "dots", "hyphens", "spaces", "marks", "plus", "at", "groups", "longest",
            "first_group", "check", "ip_like", "before", "after", "hint", "distinct")


def _features(around: _Around, c: Column) -> Column:
    v = c["v"]
    digits = F.regexp_replace(v, "[^0-9]", "")

    def count(members: str) -> Column:
        return F.length(F.regexp_replace(v, f"[^{members}]", ""))

    groups = F.filter(F.split(v, "[^0-9]+"), lambda x: x != "")
    before, last, following = around.before(c["s"], CONTEXT), around.at(c["s"] - 1), around.at(c["e"])

    def side(x: Column) -> Column:
        return F.when(x == "", 0).when(x.rlike(r"\s"), 1).when(x.rlike("[A-Za-z0-9]"), 2).when(x.rlike("[.,;:!?)]"), 3).otherwise(4)

    values = {
        "length": F.length(v), "digits": F.length(digits), "letters": count("A-Za-z"), "dots": count("."),
        "hyphens": count("-"), "spaces": count(r"\x20"), "marks": count("()/"), "plus": F.startswith(v, F.lit("+")).cast("int"),
        "at": count("@"), "groups": F.size(groups),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)),
        "first_group": F.coalesce(F.length(F.get(groups, F.lit(0))), F.lit(0)),
        "check": F.coalesce((F.length(digits).between(13, 19) & F.call_function("luhn_check", digits)).cast("int"), F.lit(0)),
        "ip_like": v.rlike(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$").cast("int"),
        "before": side(last), "after": side(following),
        "hint": F.lower(before).rlike(rf"\b(?:{_HINT_WORDS})").cast("int"),
        "distinct": F.size(F.array_distinct(F.split(digits, ""))),
    }
    return F.struct(*[values[name].cast("double").alias(name) for name in FEATURES])


def _in_order(spans: Column) -> Column:
    """Spans by start, each once."""
    return _let(F.sort_array(spans), lambda all_: F.filter(
        all_, lambda span, k: (k == 0) | (span != F.get(all_, k - 1))))


def _with_candidates(rows: DataFrame) -> DataFrame:
    """``base``, all valid spans with their kind, and ``candidates``, described spans by start, with their label."""
    text = F.col("text")
    base = F.concat(*[F.transform(k, partial(_named, k)) for k in KINDS])
    worth = text.rlike(r"[0-9@]|[(\[](?:at|AT)[)\]]")
    proposed = F.when(worth, _in_order(F.concat(*[_spans(text, pattern) for pattern in _GENERATORS])))
    proposed = F.coalesce(proposed, F.array().cast(_SPAN))
    blocks = F.when(worth, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)))
    # What the candidates of a text are held against is worked out once for the text.
    about = F.struct(proposed.alias("proposed"), blocks.alias("blocks"), *[F.col(k).alias(k) for k in KINDS])

    def described(x: Column) -> Column:
        def one(c: Column) -> Column:
            # Valid spans of a kind are in order and apart; those that a candidate meets follow each other.
            label = taken = F.lit(False)
            for kind in KINDS:
                first = _first_beyond(x[kind], "e", c["s"])
                # Confirmed: a valid span covers most of the candidate.
                most = F.exists(F.slice(x[kind], first + 1, LONGEST), lambda b: _overlaps(b, c) & (
                    2 * (F.least(b["e"], c["e"]) - F.greatest(b["s"], c["s"])) > c["e"] - c["s"]))
                there = F.size(x[kind]) > 0
                label = label | (there & most)
                taken = taken | (there & F.coalesce(F.get(x[kind], first)["s"] < c["e"], F.lit(False)))
            return F.struct(c["s"].alias("s"), c["e"].alias("e"), label.alias("label"), taken.alias("taken"),
                            _features(_Around(x["blocks"]), c).alias("f"))

        return F.transform(x["proposed"], one)

    return rows.withColumn("base", base).withColumn("candidates", _let(about, described))


def _tree(lines: list[str], value) -> Column:
    """One tree as an expression, from its printed form; takes its lines off the list."""
    line = lines.pop(0)
    if found := re.match(r"Predict: (\S+)", line):
        return F.lit(float(found[1]))
    name, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    low = _tree(lines, value)
    lines.pop(0)
    return F.when(value(FEATURES[int(name)]) <= float(limit), low).otherwise(_tree(lines, value))


@dataclass
class Model:
    """The trees as printed, with their weights, and the least probability that counts."""

    trees: list[tuple[float, str]]
    least: float

    def probability(self, f: Column) -> Column:
        total = F.lit(0.0)
        for weight, printed in self.trees:
            lines = [x.strip() for x in printed.splitlines()[1:] if x.strip()]
            total = total + F.lit(weight) * _tree(lines, lambda name: f[name])
        return 1 / (1 + F.exp(-2 * total))


def drawn(spark: SparkSession) -> DataFrame:
    """Labelled texts with digits and letters that depend on the row number alone."""
    kinds = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(label).alias("drawn"))
                      for label, texts in ((1, _PERSONAL), (0, _OTHER)) for t in texts])
    rows = spark.range(DRAWN).select("id", F.posexplode(kinds).alias("n", "x")).select(
        (-1 - F.col("id") * 1000 - F.col("n")).alias("id"), "x.*")

    def fill(c: Column, i: Column) -> Column:
        chance = F.xxhash64("id", i)
        return (F.when(c == "#", F.pmod(chance, F.lit(10)).cast("string"))
                .when(c == "%", F.char(97 + F.pmod(chance, F.lit(26)))).otherwise(c))

    return rows.select("id", "drawn", F.array_join(F.transform(F.split("t", ""), fill), "").alias("text"))


def _described(rows: DataFrame) -> DataFrame:
    return _with_candidates(_with_patterns(rows))


def examples(described: DataFrame) -> DataFrame:
    """``held_back, label, weight`` and features of all candidates of the rows and of the drawn texts.

    Candidates that the trees can't tell apart are one row with their number ``n``.
    """
    def counted(rows: DataFrame, label: str) -> DataFrame:
        each = rows.withColumn("c", F.explode("candidates")).select(
            (F.pmod(F.xxhash64("id", "c.s", "c.e"), F.lit(4)) == 0).alias("held_back"),
            F.col(label).cast("double").alias("label"), "c.f.*")
        return each.groupBy(each.columns).agg(F.count("*").alias("n"))

    own = stored(counted(described, "c.label"))
    made = counted(_described(drawn(described.sparkSession)), "drawn")
    # All of a label weigh as much as so many drawn ones at most, however many the documents hold.
    total = own.groupBy("label").agg(F.sum("n").alias("of"))
    weight = F.col("n") * F.least(F.lit(1.0), F.lit(float(WEIGHT)) / F.col("of"))
    own = own.join(F.broadcast(total), "label").withColumn("weight", weight).drop("of")
    return own.unionByName(made.withColumn("weight", F.col("n").cast("double")))


def train(described: DataFrame) -> Model | None:
    """From rows with ``candidates``; None if they can't teach anything."""
    taught = stored(examples(described))
    known = {(r.held_back, r.label) for r in taught.select("held_back", "label").distinct().collect()}
    if len(known) < 4:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(taught)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=LIMITS, seed=5, stepSize=0.3, subsamplingRate=1.0, weightCol="weight").fit(
        vectors.filter("not held_back").select("features", "label", "weight"))
    model = Model([(w, t.toDebugString) for w, t in zip(trees.treeWeights, trees.trees)], 2.0)
    scored = taught.filter("held_back").select("label", "weight", model.probability(F.struct(*FEATURES)).alias("p"))
    # A hundred bins of probability.
    bins = scored.groupBy(F.floor(F.col("p") * 100).alias("bin")).agg(
        F.sum(F.col("label") * F.col("weight")).alias("yes"), F.sum("weight").alias("n"))
    yes = n = 0
    for r in sorted(bins.collect(), key=lambda r: -r.bin):
        yes, n = yes + r.yes, n + r.n
        if yes < PRECISION * n:
            break
        model.least = max(r.bin / 100, 0.5)
    return model if model.least <= 1 else None


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_private`` for each row of ``docs``.

    ``spans`` names every span as kind:start:end, in code points, the end not included.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text_of(text_column).alias("text"))
    described = _described(rows)
    model = train(described)
    if model is None:
        described = described.withColumn("added", F.array().cast("array<struct<s:int,e:int,p:double>>"))
    else:
        open_ = F.filter("candidates", lambda c: ~c["taken"])
        scored = F.transform(open_, lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), model.probability(c["f"]).alias("p")))
        described = described.withColumn("scored", F.filter(scored, lambda c: c["p"] >= model.least))

        def better(a: Column, b: Column) -> Column:
            rank = [F.struct(x["p"], x["e"] - x["s"], -x["s"]) for x in (a, b)]
            return rank[0] > rank[1]

        def best(all_: Column) -> Column:
            def beaten(c: Column) -> Column:
                # By start: what overlaps a candidate starts less than the longest candidate before it.
                low, high = _first_beyond(all_, "s", c["s"] - LONGEST), _first_beyond(all_, "s", c["e"] - 1)
                return F.exists(F.slice(all_, low + 1, high - low), lambda o: _overlaps(o, c) & better(o, c))

            return F.filter(all_, lambda c: ~beaten(c))

        described = described.withColumn("added", F.array_sort(_let(F.col("scored"), best)))
    named = F.array_join(F.transform("base", lambda x: F.format_string("%s:%d:%d", x["k"], x["s"], x["e"])), ",")
    added = F.array_join(F.transform("added", lambda x: F.format_string("%s:%d:%d", F.lit(ADDED), x["s"], x["e"])), ",")
    return described.select(
        F.col("id").alias("doc_id"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(named.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.when(named != "", named), F.when(added != "", added)).alias("spans"),
        F.size("added").cast("long").alias("n_private"))
