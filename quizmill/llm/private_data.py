"""Personal data in texts: spans that rules find for certain, and further ones that boosted trees select.

Rules find emails, IP numbers, card numbers and phone numbers, the leftmost first, and check each match once;
a match that fails is dropped with all it holds. So two card numbers in a row, or a phone number before an IP
number, are lost to them. Generators therefore propose spans of their own, narrower and overlapping; each
gets features of its format (digits, separators, check digit, parts) and of its context (what it touches,
words before it). Trees are boosted on the candidates that stand apart: those that are a span of the rules
count as private, the others as not; candidates that touch what could be part of a longer match have no
label. A format that no labelled private candidate has counts as not private. Thresholds are set for each
kind on the other half of the labelled candidates: the lowest score from which on at least ``precision`` of
them are private. Selected candidates that overlap no span of the rules are added, the better of two that
overlap each other; the rules' spans all stay.

All work on texts is done by SQL functions; one pass leaves a narrow table of spans and candidates. Trees
need only how often each combination of feature values occurs, which Spark counts over all candidates. Where
there are at most ``vectors`` combinations, they reach the driver, which grows the trees; of more, Spark sums
gradients by node, feature and value, and only these sums reach it. No combination is left out. Places are
counted in code points from 0, ends are exclusive. Null texts count as empty; rows are judged each on
its own, so ids may repeat or be null. Without labelled candidates nothing is added.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from math import exp, inf, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import materialize

KINDS = ("email", "ip", "card", "phone")

# The rules' patterns, written so that each match is found in a time in proportion to its length: a run of
# letters is tried at its first place only (or where the last match ended), repeated groups give nothing back.
_LOCAL = "A-Za-z0-9._%+-"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
RULES = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
#: Generators: kind, pattern.
GENERATORS = (
    ("email", r"(?<![^\s<>()\[\],;:\x22])[^\s<>()\[\],;:\x22@]++@[^\s<>()\[\],;:\x22@]*[A-Za-z0-9]"),
    ("email", rf"(?<![{_LOCAL}])[{_LOCAL}]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?[\[(]dot[\])] ?[A-Za-z0-9-]++)++"),
    ("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", r"(?<![0-9])[0-9]{1,4}(?:\.[0-9]{1,4}){3}(?![0-9])"),
    ("ip", rf"(?<![0-9]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{14,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}([\x20-])[0-9]{6}\1[0-9]{4,5}(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}[\x20.-]?\([0-9]{2,5}\)[\x20.-]?[0-9]{2,5}(?:[\x20.-][0-9]{2,5})?(?![0-9])"),
    ("phone", r"\+[0-9]{1,3}(?:[\x20.-][0-9]{2,4}){2,4}(?![0-9])"),
    ("phone", r"\+[0-9]{7,17}(?![0-9])"),
    ("phone", r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])"),
)
#: Words before a span that tell what it is, by class; characters before a span that are looked at.
_CUES = (r"(?:version|release|v)[.:]?\s*$", r"(?:=|token|key|hash|sha|id)\W*$", r"(?:tel|phone|call|fax|mail|contact|card|visa|ip|host|address)\W*$")
_BEFORE, _BLOCK = 16, 64
FEATURES = ("kind", "digits", "others", "plus", "parens", "check", "parts", "varied", "letters", "left", "right", "cue")
_FORMAT = ("kind", "plus", "parens", "letters")
_SPAN = "struct<start: int, kind: int, end: int>"
_HIT = "struct<kind: int, start: int, hit: string, before: string, after: string>"

# SQL texts below: one text is read at once, where columns would be built call by call.


def _let(name: str, value: str, body: str) -> str:
    """``body`` in which ``name`` stands for ``value``, which is computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _regex(pattern: str) -> str:
    return f"r'{pattern}'"


def _running(lengths: str) -> str:
    """Sums of all entries before each, by blocks, so that a long array isn't copied once an entry."""
    grow = lambda xs, first: f"aggregate({xs}, struct({first} as s, cast(array() as array<int>) as o), (a, v) -> struct(a.s + v as s, array_append(a.o, a.s) as o), a -> a.o)"
    blocks = f"transform(sequence(0, greatest(size(l) - 1, 0), {_BLOCK}), at -> slice(l, at + 1, {_BLOCK}))"
    firsts = grow("transform(b, ys -> aggregate(ys, 0, (a, v) -> a + v))", "0")
    return _let("l", lengths, _let("b", blocks, f"flatten(zip_with(b, {firsts}, (xs, first) -> {grow('xs', 'first')}))"))


def _hits(n: int, kind: int) -> str:
    """``_HIT`` of each match ``m{n}`` between the pieces ``p{n}``."""
    m, p, size = f"m{n}", f"p{n}", f"size(m{n})"
    lengths = f"zip_with({p}, {m}, (p, m) -> length(p) + coalesce(length(m), 0))"
    before = f"zip_with(slice(concat(array(''), {m}), 1, {size}), slice({p}, 1, {size}), (m, p) -> right(concat(m, p), {_BEFORE}))"
    after = f"zip_with(slice({p}, 2, {size}), slice(concat({m}, array('')), 2, {size}), (p, m) -> left(concat(p, m), 2))"
    gaps = f"transform(slice({p}, 1, {size}), p -> length(p))"
    row = f"named_struct('kind', {kind}, 'start', x.`0` + x.`1`, 'hit', x.{m}, 'before', x.`3`, 'after', x.`4`)"
    return f"if({size} = 0, cast(array() as array<{_HIT}>), transform(slice(arrays_zip({_running(lengths)}, {gaps}, {m}, {before}, {after}), 1, {size}), x -> {row}))"


#: Of a match ``h`` with the digits ``d``: what the rules check besides.
_VALID = f"case h.kind when 1 then h.hit rlike {_regex(f'^{_PART}(?:[.]{_PART}){{3}}$')} when 2 then luhn_check(d) when 3 then length(d) between 10 and 15 else true end"
#: Whether it touches what the rules could have taken for part of a longer match.
_JOINED = r"""case h.kind when 1 then h.before rlike r'[0-9][.]$' or h.after rlike r'^[.][0-9]' when 2 then h.before rlike r'[0-9][\x20-]?$' or h.after rlike r'^[\x20-]?[0-9]'
    when 3 then h.after rlike r'^[\x20().0-9-]*[0-9]' else false end"""
_WHOLE = "case h.kind " + " ".join(f"when {k} then h.hit rlike {_regex(f'^(?:{RULES[kind]})$')}" for k, kind in enumerate(KINDS)) + " end"
#: Class of a neighbouring character: none or blank, letter, digit, quote, other.
_SIDE = r"case when {0} = '' or {0} rlike r'\s' then 0 when {0} rlike r'\p{{L}}' then 1 when {0} rlike '[0-9]' then 2 when {0} rlike r'[\x22\x27\x60]' then 3 else 4 end"
_VALUES = {
    "kind": "h.kind",
    "digits": "least(length(d), 24)",
    "others": "if(h.kind = 0, 0, least(length(h.hit) - length(d), 6))",
    "plus": "int(startswith(h.hit, '+'))",
    "parens": "int(contains(h.hit, '('))",
    "check": f"int(case h.kind when 0 then h.hit rlike {_regex(f'^[{_LOCAL}]++@[A-Za-z0-9.-]*[.][A-Za-z0-9-]+$')} when 3 then false else {_VALID} end)",
    "parts": "least(size(split(h.hit, r'[^0-9A-Za-z]+')), 8)",
    "varied": "if(h.kind = 0, 0, least(size(array_distinct(split(d, ''))), 5))",
    "letters": "int(h.hit rlike '[A-Za-z]')",
    "left": _SIDE.format("right(h.before, 1)"),
    "right": _SIDE.format("left(h.after, 1)"),
    "cue": "case " + " ".join(f"when lower(h.before) rlike {_regex(c)} then {k + 1}" for k, c in enumerate(_CUES)) + " else 0 end",
}
_CANDIDATE = _let("d", "regexp_replace(h.hit, '[^0-9]', '')", f"""named_struct('start', h.start, 'kind', h.kind, 'end', h.start + length(h.hit),
    'x', named_struct({', '.join(f"'{f}', {_VALUES[f]}" for f in FEATURES)}), 'joined', {_JOINED}, 'private', {_WHOLE} and {_VALID})""")
#: A text without this has no match of the kind; cheaper than the pattern.
_NEEDS = {"email": "contains(t, '@') or contains(t, 'at')", "ip": "t rlike '[0-9][.][0-9]'", "card": "t rlike '[0-9]'", "phone": "t rlike '[0-9]'"}


def spans_and_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, candidates`` for each row, by SQL functions over the whole text; a span that several
    generators propose is several candidates.

    A text is cut by all matches of a pattern, so matches and the pieces between them give each place."""
    patterns = [(k, RULES[k]) for k in KINDS] + list(GENERATORS)
    all_n, rules, made = range(len(patterns)), range(len(KINDS)), range(len(KINDS), len(patterns))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"))
    rows = rows.selectExpr("doc_id", "t", *[f"if({_NEEDS[kind]}, regexp_extract_all(t, {_regex(p)}, 0), cast(array() as array<string>)) as m{n}" for n, (kind, p) in enumerate(patterns)])
    # the text is cut only where something was found
    rows = rows.selectExpr("doc_id", *[f"m{n}" for n in all_n], *[f"if(size(m{n}) > 0, split(t, {_regex(patterns[n][1])}, -1), cast(array() as array<string>)) as p{n}" for n in all_n])
    hits = lambda ns: f"concat({', '.join(_hits(n, KINDS.index(patterns[n][0])) for n in ns)})"
    ruled = f"filter({hits(rules)}, h -> {_let('d', "regexp_replace(h.hit, '[^0-9]', '')", _VALID)})"
    base = f"array_sort(transform({ruled}, h -> named_struct('start', h.start, 'kind', h.kind, 'end', h.start + length(h.hit))))"
    return rows.selectExpr("doc_id", f"{base} as base", f"transform({hits(made)}, h -> {_CANDIDATE}) as candidates")


@dataclass
class Trees:
    """Boosted trees over whole-number features, and a threshold for each kind."""

    trees: list = field(default_factory=list)
    start: float = 0.0
    thresholds: dict[int, float] = field(default_factory=dict)

    def score(self, x: str) -> str:
        """The sum of the trees' leaves, as SQL over the struct of features ``x``."""

        def of(node) -> str:
            return f"{node!r}D" if isinstance(node, float) else f"if({x}.{node[0]} <= {node[1]}, {of(node[2])}, {of(node[3])})"

        return " + ".join([f"{float(self.start)!r}D", *map(of, self.trees)])

    def value(self, x: dict[str, int]) -> float:
        def of(node) -> float:
            return node if isinstance(node, float) else of(node[2] if x[node[0]] <= node[1] else node[3])

        total = self.start
        for t in self.trees:  # one after another, as the SQL form adds them: thresholds are compared with its scores
            total += of(t)
        return total


def boost(counts: list[tuple[dict[str, int], int, int]], rounds: int = 20, depth: int = 3, rate: float = 0.4, damping: float = 1.0) -> Trees:
    """Trees by second-order gradient boosting of the logistic loss. ``counts``: feature values, how many
    such candidates are private and how many aren't."""
    model = Trees()
    yes, no = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not counts or not yes:
        return model
    model.start = log((yes + 0.5) / (no + 0.5))
    margin = [model.start] * len(counts)

    def grow(rows: list[int], left: int):
        g, h = sum(grad[i] for i in rows), sum(hess[i] for i in rows)
        best = (1e-6, None, None)
        if left:
            for f in FEATURES:
                bins: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
                for i in rows:
                    b = bins[counts[i][0][f]]
                    b[0] += grad[i]
                    b[1] += hess[i]
                gl = hl = 0.0
                for cut in sorted(bins)[:-1]:
                    gl, hl = gl + bins[cut][0], hl + bins[cut][1]
                    gain = gl * gl / (hl + damping) + (g - gl) ** 2 / (h - hl + damping) - g * g / (h + damping)
                    if gain > best[0]:
                        best = (gain, f, cut)
        if best[1] is None:
            return -rate * g / (h + damping)
        low, high = ([i for i in rows if (counts[i][0][best[1]] <= best[2]) == side] for side in (True, False))
        return best[1], best[2], grow(low, left - 1), grow(high, left - 1)

    for _ in range(rounds):
        p = [1 / (1 + exp(-max(-30.0, min(30.0, m)))) for m in margin]
        grad = [(yes + no) * p[i] - yes for i, (_, yes, no) in enumerate(counts)]
        hess = [(yes + no) * p[i] * (1 - p[i]) for i, (_, yes, no) in enumerate(counts)]
        tree = grow(list(range(len(counts))), depth)
        model.trees.append(tree)
        only = Trees([tree])
        margin = [m + only.value(c[0]) for m, c in zip(margin, counts, strict=True)]
    return model


def calibrate(model: Trees, counts: list[tuple[dict[str, int], int, int]], precision: float) -> None:
    """For each kind the lowest score from which on at least ``precision`` of the candidates are private;
    none where no score is."""
    for kind in {x["kind"] for x, _, _ in counts}:
        scored = sorted(((model.value(x), yes, no) for x, yes, no in counts if x["kind"] == kind), reverse=True)
        yes = no = 0
        best = inf
        for k, (s, a, b) in enumerate(scored):
            yes, no = yes + a, no + b
            if (k + 1 == len(scored) or scored[k + 1][0] < s) and yes and yes >= precision * (yes + no):
                best = s
        model.thresholds[kind] = float(best)


def boost_by_sums(table: DataFrame, rounds: int = 20, depth: int = 3, rate: float = 0.4, damping: float = 1.0) -> Trees:
    """The trees of ``boost`` for ``x, yes, no`` of very many combinations: each level of a tree needs the
    sums of gradients by node, feature and value, some thousand numbers. Sums are of whole numbers, so they
    don't depend on the order of rows."""
    model, unit = Trees(), float(1 << 20)
    yes, no = table.agg(F.coalesce(F.sum("yes"), F.lit(0)), F.coalesce(F.sum("no"), F.lit(0))).first()
    if not yes:
        return model
    model.start = log((yes + 0.5) / (no + 0.5))
    leaf = lambda g, h: -rate * g / (h + damping)
    values = ", ".join(f"struct({k} as f, x.{f} as v)" for k, f in enumerate(FEATURES))

    for _ in range(rounds):
        rows = table.withColumn("p", F.expr(f"1 / (1 + exp(-greatest(-30D, least(30D, {model.score('x')}))))"))
        whole = lambda sql: F.expr(f"cast(round(({sql}) * {unit!r}D) as decimal(38, 0))")
        rows = rows.withColumns({"g": whole("(yes + no) * p - yes"), "h": whole("(yes + no) * p * (1 - p)")})
        # a node is a list: its leaf value, or feature, cut and two nodes
        root: list = [0.0]
        open_nodes = [root]
        for _ in range(depth):
            number = {id(n): k for k, n in enumerate(open_nodes)}
            place = lambda n: f"if(x.{n[0]} <= {n[1]}, {place(n[2])}, {place(n[3])})" if len(n) > 1 else str(number.get(id(n), -1))  # noqa: B023, E731
            sums = rows.withColumn("node", F.expr(place(root))).where("node >= 0").select("node", "g", "h", F.expr(f"inline(array({values}))"))
            bins: dict[tuple[int, int], list] = defaultdict(list)
            for node, f, v, g, h in sums.groupBy("node", "f", "v").agg(F.sum("g"), F.sum("h")).collect():
                bins[node, f].append((v, int(g), int(h)))
            following = []
            for k, n in enumerate(open_nodes):
                total_g, total_h = (sum(b[c] for b in bins[k, 0]) for c in (1, 2))
                g, h = total_g / unit, total_h / unit
                best, found = 1e-6, None
                for f in range(len(FEATURES)):
                    gl = hl = 0
                    for cut, bg, bh in sorted(bins[k, f])[:-1]:
                        gl, hl = gl + bg, hl + bh
                        low, high = (gl / unit, hl / unit), ((total_g - gl) / unit, (total_h - hl) / unit)
                        gain = low[0] ** 2 / (low[1] + damping) + high[0] ** 2 / (high[1] + damping) - g * g / (h + damping)
                        if gain > best:
                            best, found = gain, (FEATURES[f], cut, [leaf(*low)], [leaf(*high)])
                n[:] = found or [leaf(g, h)]
                following += n[2:]
            open_nodes = following
        tree = lambda n: (n[0], n[1], tree(n[2]), tree(n[3])) if len(n) > 1 else n[0]  # noqa: B023, E731
        model.trees.append(tree(root))
    return model


def calibrate_by_sums(model: Trees, table: DataFrame, precision: float) -> None:
    """The thresholds of ``calibrate`` for ``x, yes, no`` of very many combinations: running sums from the
    highest score on, within ranges of scores and over the ranges."""
    ranges = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scores = table.select("x.kind", F.expr(model.score("x")).alias("score"), "yes", "no").groupBy("kind", "score").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    scores = materialize(scores.repartitionByRange(ranges, F.col("kind"), F.desc("score")).withColumn("part", F.spark_partition_id()))
    sums = scores.groupBy("kind", "part").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
    earlier = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("kind", "part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("yes", "no")])
    upto = Window.partitionBy("kind", "part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    scores = scores.withColumns({c: F.sum(c).over(upto) for c in ("yes", "no")}).join(sums, ["kind", "part"])
    scores = scores.select("kind", "score", (F.col("yes") + F.col("yes_before")).alias("yes"), (F.col("no") + F.col("no_before")).alias("no"))
    fits = (F.col("yes") > 0) & (F.col("yes") >= F.lit(precision) * (F.col("yes") + F.col("no")))
    for kind, least in scores.groupBy("kind").agg(F.min(F.when(fits, F.col("score")))).collect():
        model.thresholds[kind] = inf if least is None else least


def fit_trees(table: DataFrame, precision: float = 0.98, vectors: int = 4096) -> Trees:
    """Trees and thresholds from the candidates of ``spans_and_candidates``. More than ``vectors``
    combinations of feature values stay in Spark, see ``boost_by_sums``."""
    each = table.select("doc_id", F.explode("candidates").alias("c")).select("c.x.*", F.pmod(F.xxhash64("doc_id", "c.start"), F.lit(2)).alias("half"), "c.joined", "c.private")
    labelled = ~F.col("joined")
    of_half = lambda h, private: F.sum((labelled & (F.col("half") == h) & (F.col("private") == private)).cast("long"))
    sums = [of_half(h, p).alias(f"n{h}{int(p)}") for h in (0, 1) for p in (True, False)]
    counts = materialize(each.groupBy(*FEATURES).agg(F.count("*").alias("n"), *sums))
    if counts.count() > vectors:
        formats = counts.groupBy(*_FORMAT).agg((F.sum(F.col("n01") + F.col("n11")) == 0).cast("long").alias("unknown"))
        counts = materialize(counts.join(F.broadcast(formats), list(_FORMAT)).select(F.struct(*FEATURES).alias("x"), "n01", "n00", "n11", "n10", "unknown"))
        half = lambda h: counts.select("x", F.col(f"n{h}1").alias("yes"), (F.col(f"n{h}0") + F.col("unknown")).alias("no")).where("yes + no > 0")
        model = boost_by_sums(half(0))
        calibrate_by_sums(model, half(1), precision)
        return model
    found = counts.orderBy(F.desc("n"), *FEATURES).collect()
    rows = [({f: r[f] for f in FEATURES}, r.n01, r.n00, r.n11, r.n10) for r in found]
    known = {tuple(x[f] for f in _FORMAT) for x, a, _, b, _ in rows if a + b}
    unknown = [(x, 0, 1) for x, *_ in rows if tuple(x[f] for f in _FORMAT) not in known]
    model = boost([(x, a, b) for x, a, b, _, _ in rows if a + b] + unknown)
    calibrate(model, [(x, a, b) for x, _, _, a, b in rows if a + b] + unknown, precision)
    return model


def find_private(docs: DataFrame, precision: float = 0.98, vectors: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, added`` for each row: arrays of ``start, kind, end``, kinds as numbers of ``KINDS``."""
    table = materialize(spans_and_candidates(docs, id_col, text_col))
    model = fit_trees(table, precision, vectors)
    least = ", ".join(f"double('{model.thresholds.get(k, inf)}')" for k in range(len(KINDS)))
    scored = f"transform(candidates, c -> named_struct('start', c.start, 'kind', c.kind, 'end', c.end, 'score', {model.score('c.x')}))"
    table = table.withColumn("picked", F.expr(f"filter({scored}, c -> c.score >= element_at(array({least}), c.kind + 1))"))
    return table.select("doc_id", "base", _apart(F.col("base"), F.col("picked")).alias("added"))


def _apart(base: Column, picked: Column) -> Column:
    """Of the picked candidates those that overlap no base span, the better of two that overlap each other:
    one sweep over all by start, with the last candidate kept back until nothing can overlap it."""
    kind = "struct<start: int, own: int, kind: int, end: int, score: double>"
    state = f"struct<out: array<{_SPAN}>, held: {kind}, taken: int>"
    row = lambda x, own, score: F.struct(x["start"].alias("start"), F.lit(own).alias("own"), x["kind"].alias("kind"), x["end"].alias("end"), score.alias("score")).cast(kind)
    rows = F.array_sort(F.concat(F.transform(base, lambda b: row(b, 0, F.lit(0.0))), F.transform(picked, lambda c: row(c, 1, c["score"]))))
    span = lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end")).cast(_SPAN)
    none = F.lit(None).cast(kind)

    def step(a: Column, x: Column) -> Column:
        held, is_base = a["held"], x["own"] == 0
        free = held.isNotNull() & (held["end"] <= x["start"])
        out = F.when(free, F.array_append(a["out"], span(held))).otherwise(a["out"])
        usable = ~is_base & (x["start"] >= a["taken"])
        better = (x["score"] > held["score"]) | ((x["score"] == held["score"]) & (x["end"] > held["end"]))
        now = F.when(is_base, none).when(~usable, F.when(free, none).otherwise(held)).when(held.isNull() | free | better, x).otherwise(held)
        return F.struct(out.alias("out"), now.alias("held"), F.when(is_base, F.greatest(a["taken"], x["end"])).otherwise(a["taken"]).alias("taken")).cast(state)

    start = F.struct(F.array().cast(f"array<{_SPAN}>").alias("out"), none.alias("held"), F.lit(0).alias("taken")).cast(state)
    return F.reduce(rows, start, step, lambda a: F.when(a["held"].isNotNull(), F.array_append(a["out"], span(a["held"]))).otherwise(a["out"]))


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, in order, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
