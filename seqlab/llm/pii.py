"""Personal data: generated candidates, boosted trees, calibrated thresholds.

Base formats (``BASE``) are always redacted. High-recall generators propose
further, overlapping spans (numbers without a plus, spelled-out addresses,
hardware addresses, account and identity numbers).

Boosted trees score every candidate from its format and context. The format
features include what follows from the characters alone (``valid``): the IBAN's
length and remainder, the SSN's area, group and serial, the fields of MAC and
IPv6, the top level domain of an address. Labels come from ``_labelled``: for
hardware and identity numbers that check defines a right span; an address is
also right after a cue word; a number is right if it overlaps a base span or
follows a cue word, which its features do not show. Per kind the threshold is
the lowest score at which candidates of the calibration half are right in
``precision`` of the cases. Added are the candidates whose score reaches the
threshold of their kind, if they overlap no base span and no better candidate;
their labels are not asked. A kind with fewer than ``LEAST`` right or wrong
candidates in a half cannot be fitted; there the labels stand alone.

Everything is DataFrame functions and Spark ML on the JVM. Patterns keep the
published formats' matches but use possessive groups (no recursion, so long
runs cannot overflow the stack) and start only where a run starts or the last
match ended (``\\G``), which makes them linear in the text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seqlab.llm.common import id_and_text, saved

KINDS = ("email", "ip", "card", "phone", "address", "hardware", "identity", "number")
# fixed values: base formats
_LOCAL = "[A-Za-z0-9._%+-]"
EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"
IP_VALID = rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"
# registered IBAN lengths
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
_IBAN = "|".join(rf"(?:{'|'.join(c.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items())
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
SSN_VALID = r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"
_HEX = "[0-9A-Fa-f]"
MAC_VALID = rf"^{_HEX}{{2}}(?:(?::{_HEX}{{2}}){{5}}|(?:-{_HEX}{{2}}){{5}})$"
IPV6_FULL = rf"^{_HEX}{{1,4}}(?::{_HEX}{{1,4}}){{7}}$"
_AT = r"(?:\((?i:at)\)|\[(?i:at)\]|\{(?i:at)\})"
_DOT = r"(?:\((?i:dot)\)|\[(?i:dot)\]|\{(?i:dot)\})"
# generators: (kind, pattern, what every text with a match shows or None)
GENERATORS = (
    ("address", rf"(?<!{_LOCAL}){_LOCAL}++ ?{_AT} ?[A-Za-z0-9-]++"
                rf"(?:(?:\.| \. | ?{_DOT} ?| dot )[A-Za-z0-9-]++)++", _AT),
    ("hardware", rf"(?<![0-9A-Za-z:-])(?:{_HEX}{{1,4}}(?::{_HEX}{{1,4}}){{5,7}}+|{_HEX}{{2}}(?:-{_HEX}{{2}}){{5}}"
                 rf"|(?:{_HEX}{{1,4}}:){{1,6}}(?::{_HEX}{{1,4}}){{1,6}}+)(?![0-9A-Za-z:-])", "[:-]"),
    ("identity", rf"(?<![0-9A-Za-z-])(?:{_SSN}|{_IBAN}|[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}+)"
                 r"(?![0-9A-Za-z-])", None),
    ("number", r"(?<![0-9A-Za-z.+])[0-9](?:[ ().-]{0,2}[0-9]){6,18}+(?![0-9A-Za-z])", None),
)
CUES = (r"(?i)\b(?:tel|phone|call|fax|mobil|cell|telefon|téléphone|card|visa|iban|account|konto|ssn|passport|"
        r"mail|contact|kontakt|correo|llam|appel|ip|host|server|addr)")
NUMBER_CUES = (r"(?i)\b(?:tel|tél|phone|call|fax|mobil|cell|card|visa|account|konto|passport|llam|appel)"
               r"[\p{L}.]{0,10}[ :#=-]{0,3}(?:(?:me|us|no|nr|number|is|at)\b[ .:#=-]{0,3}){0,3}[(]?$")
ADDRESS_CUES = r"(?i)\b(?:e-?mail|mail|contact|kontakt|correo|reach|write|addr)"
TLDS = ("com org net edu gov mil int info biz name pro dev app io ai co example test "
        "ac ad ae af ag al am ar at au az ba bd be bg bh bo br by bz ca cc ch ci cl cm cn cr cu cy cz de dk do dz ec "
        "ee eg es et eu fi fj fm fr ge gh gr gt hk hn hr hu id ie il in iq ir is it jm jo jp ke kg kh kr kw kz la lb "
        "li lk lt lu lv ly ma mc md me mg mk mm mn mo mt mu mv mx my mz na ng ni nl no np nz om pa pe ph pk pl ps pt "
        "py qa ro rs ru rw sa sd se sg si sk sm sn sv sy th tj tm tn tr tt tv tw tz ua ug uk us uy uz va ve vn ws ye "
        "za zm zw").split()
FEATURES = ("length", "digits", "separators", "groups", "letters", "parens", "repeats", "left_blank",
            "right_blank", "left_letter", "right_letter", "cue", "cue_near", "valid", "dated", "nested",
            *(f"is_{k}" for k, _, _ in GENERATORS))
PRECISION = 0.95
LEAST = 5
MOST_WEIGHT = 5_000     # as so many candidates a kind weighs at most, so that no kind outweighs the others
_FIT_ROWS = 100_000     # distinct rows a partition of the fit
_BINS = 1 << 15         # all distinct values are splits; Spark takes the values from its square of rows at least: from all
_BLOCK = 128   # items by which an array grows
_SPAN = "struct<start:int,rank:int,kind:string,end:int>"


def _blocks(items: Column) -> Column:
    """``items`` (a column of its own, so that it is computed once) in blocks: what is built along them grows by
    blocks, so the work stays in proportion to the items."""
    last = F.floor(F.greatest(F.size(items) - 1, F.lit(0)) / _BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * _BLOCK + 1, _BLOCK))


def _with_matches(df: DataFrame, patterns: dict) -> DataFrame:
    """``df`` (column ``text``) with, for every name of ``patterns`` (a pattern and
    what a text with a match fulfils, or None), the array<struct<start, end, match,
    left, right>> of its leftmost non-overlapping matches: position (code points,
    end exclusive), up to 30 characters before and some of those after.

    The lengths of matches and of the pieces between them give the positions.
    Each step is a projection, so that no list of matches is computed twice.
    """
    text, none = F.col("text"), F.array().cast("array<string>")
    df = df.withColumns({f"m_{k}": F.when(
        text.rlike(p) if holds is None else holds & text.rlike(p),
        F.regexp_extract_all(text, F.lit(p), F.lit(0))).otherwise(none) for k, (p, holds) in patterns.items()})
    df = df.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split(text, p, -1)).otherwise(none)
                         for k, (p, _) in patterns.items()})
    df = df.withColumns({f"z_{k}": _pieces(f"m_{k}", f"p_{k}") for k in patterns})
    df = df.withColumns({k: _placed(f"z_{k}") for k in patterns})
    return df.drop(*[f"{x}_{k}" for x in "mpz" for k in patterns])


def _pieces(m: str, p: str) -> Column:
    """Per match: itself, the text since the one before, and the text that follows."""
    return F.expr(f"""
        zip_with(zip_with({m}, slice({p}, 1, size({m})), (x, y) -> named_struct('m', x, 'p', y)),
                 zip_with(slice({p}, 2, size({m})), slice({m}, 2, size({m})), (x, y) -> concat(x, coalesce(y, ''))),
                 (x, y) -> named_struct('m', x.m, 'p', x.p, 'after', y))""")


def _placed(items: str) -> Column:
    """The matches of ``_pieces`` with their positions. Each block of items starts from what was found before it:
    the sum of lengths, and the characters on its left, which the 30 items before it hold (a match is not empty)."""
    item = "struct<start:int,end:int,match:string,left:string,right:string>"
    begin, before = "b.at + length(x.p)", "right(concat(b.tail, x.p), 30)"
    last = f"int(floor(greatest(size({items}) - 1, 0) / {_BLOCK}))"
    blocks = f"transform(sequence(0, {last}), i -> slice({items}, i * {_BLOCK} + 1, {_BLOCK}))"
    return F.expr(f"""
        flatten(zip_with(
            zip_with(
                {blocks},
                aggregate(
                    slice(transform({blocks}, block -> aggregate(block, 0, (n, x) -> n + length(x.p) + length(x.m))),
                          1, {last}),
                    array(0), (a, n) -> array_append(a, element_at(a, -1) + n)),
                (block, at) -> named_struct('block', block, 'at', at)),
            transform(sequence(0, {last}), i -> if(i = 0, '', right(array_join(transform(
                slice({items}, greatest(i * {_BLOCK} - 29, 1), 30), x -> concat(x.p, x.m)), ''), 30))),
            (start, tail) -> aggregate(
                start.block,
                named_struct('at', start.at, 'tail', tail, 'out', cast(array() AS array<{item}>)),
                (b, x) -> named_struct(
                    'at', {begin} + length(x.m), 'tail', right(concat({before}, x.m), 30),
                    'out', array_append(b.out, named_struct(
                        'start', {begin}, 'end', {begin} + length(x.m), 'match', x.m, 'left', {before},
                        'right', substring(x.after, 1, 10)))),
                b -> b.out)))""")


def _steps(arrays: Column) -> Column:
    """Powers of two, falling, for binary searches in any of ``arrays``."""
    most = F.array_max(F.transform(arrays, lambda a: F.size(a)))
    return F.transform(F.sequence(F.floor(F.log2(F.greatest(most, F.lit(1)))).cast("int"), F.lit(0), F.lit(-1)),
                       lambda i: F.pow(F.lit(2.0), i).cast("int"))


def _how_many(spans: Column, steps: Column, holds) -> Column:
    """How many of ``spans`` from the first on fulfil ``holds`` (a prefix does)."""
    return F.aggregate(steps, F.lit(0), lambda n, s: F.when(
        holds(F.get(spans, n + s - 1)), n + s).otherwise(n))


def _meets(spans: Column, steps: Column, c: Column) -> Column:
    """Whether one of ``spans`` (sorted, disjoint) overlaps ``c``."""
    n = _how_many(spans, steps, lambda x: x["start"] < c["end"])
    return F.coalesce(F.get(spans, n - 1)["end"] > c["start"], F.lit(False))


def _only(spans: str, kind: str) -> Column:
    return F.filter(spans, lambda x: x["kind"] == kind)


def _span_of(rank: int, kind: str):
    return lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                              m["end"].alias("end"))


def _of_kind(kind: str):
    return lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), F.lit(kind).alias("kind"),
                              m["match"].alias("match"), m["left"].alias("left"), m["right"].alias("right"))


def _scanned(rows: DataFrame) -> DataFrame:
    """``rows`` (id, row_hash, text) with the base spans and the candidates."""
    text = F.col("text")
    digits = lambda m: F.regexp_replace(m["match"], "[^0-9]", "")
    base = (
        ("email", EMAIL, F.contains(text, F.lit("@")), None),
        ("ip", IP, F.contains(text, F.lit(".")), lambda m: m["match"].rlike(IP_VALID)),
        ("card", CARD, None, lambda m: F.length(digits(m)).between(14, 19) & F.call_function("luhn_check", digits(m))),
        ("phone", PHONE, F.contains(text, F.lit("+")), lambda m: F.length(digits(m)).between(10, 15)),
    )
    found = _with_matches(rows, {
        **{k: (pattern, holds) for k, pattern, holds, _ in base},
        **{k: (pattern, text.rlike(holds) if holds else None) for k, pattern, holds in GENERATORS}})
    spans = [F.transform(F.filter(k, valid) if valid else F.col(k), _span_of(rank, k))
             for rank, (k, _, _, valid) in enumerate(base)]
    cands = [F.transform(k, _of_kind(k)) for k, _, _ in GENERATORS]
    return found.select("id", "row_hash", F.array_sort(F.concat(*spans)).alias("base"), F.concat(*cands).alias("cand"))


def _labelled(c: DataFrame) -> DataFrame:
    """``label`` (1: right), and the format features ``valid`` (the check on the
    characters), ``dated`` (reads like a date) and ``nested`` (an SSN, or inside a
    hardware or identity candidate). Needs ``on`` (overlaps a base span) and
    ``inside`` (overlaps a candidate with a complete check)."""
    match, left = F.col("match"), F.col("left")
    plain = F.regexp_replace(match, " ", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))

    def step(acc, ch):
        code = F.ascii(ch)
        return F.when(code < 58, acc * 10 + code - 48).otherwise(acc * 100 + code - 55) % 97

    rest = F.aggregate(F.filter(F.split(turned, ""), lambda ch: ch != ""), F.lit(0), step)
    lengths = F.create_map(*[F.lit(x) for n, cs in IBAN_LENGTHS.items() for c2 in cs.split() for x in (c2, n)])
    length = F.element_at(lengths, F.substring(plain, 1, 2))   # null: not registered
    iban = (F.length(plain) == F.coalesce(length, F.length(plain))) & (rest == 1)
    groups = F.size(F.split(match, ":+", -1))
    # compressed: fewer than eight groups, and not two words joined by colons
    ipv6 = match.rlike(IPV6_FULL) | (F.contains(match, F.lit("::")) & groups.between(3, 7) & match.rlike("[0-9]"))
    top = F.lower(F.regexp_extract(match, "([A-Za-z0-9-]+)$", 1))
    worded = top.rlike("^[a-z]{2,24}$")
    ssn = match.rlike(f"^{_SSN}$")
    nested = F.col("inside") | ssn
    dated = match.rlike("^(?:19|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9])")
    valid = {
        "address": worded & top.isin(*TLDS),
        "hardware": match.rlike(MAC_VALID) | ipv6,
        "identity": F.when(ssn, match.rlike(SSN_VALID)).otherwise(iban),
        "number": F.lit(False),
    }
    right = {
        **valid, "address": worded & (top.isin(*TLDS) | left.rlike(ADDRESS_CUES)),
        "number": F.col("on") | (~nested & ~dated & left.rlike(NUMBER_CUES)),
    }

    def of_kind(cases):
        found = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in cases.items()], F.lit(False))
        return found.cast("double")
    return c.withColumns({"label": of_kind(right), "valid": of_kind(valid), "dated": dated.cast("double"),
                          "nested": (nested & (F.col("kind") == "number")).cast("double")})


def _features(c: DataFrame) -> DataFrame:
    def count(pattern):
        return F.length("match") - F.length(F.regexp_replace("match", pattern, ""))

    flag = lambda col: col.cast("double")
    shown = ~F.col("kind").isin("address", "number")
    return c.withColumns({
        "length": F.length("match").cast("double"), "digits": flag(count("[0-9]")),
        "separators": flag(count("[ .()/:-]")), "letters": flag(count("[A-Za-z]")), "parens": flag(count("[()]")),
        "groups": flag(F.size(F.split("match", "[^0-9A-Za-z]+", -1))),
        "repeats": flag(F.length("match") - F.length(F.regexp_replace("match", r"(.)\1", "$1"))),
        "left_blank": flag(F.col("left").rlike(r"(?:^|\s)$")), "right_blank": flag(F.col("right").rlike(r"^(?:\s|$)")),
        "left_letter": flag(F.col("left").rlike("[A-Za-z]$")), "right_letter": flag(F.col("right").rlike("^[A-Za-z]")),
        # not where a cue is the label
        "cue": flag(shown & F.col("left").rlike(CUES)),
        "cue_near": flag(shown & F.substring("left", -12, 12).rlike(CUES)),
        **{f"is_{k}": flag(F.col("kind") == k) for k, _, _ in GENERATORS},
    })


def _select(cand: DataFrame, precision: float) -> DataFrame:
    """Candidates whose score reaches the threshold of their kind (``score``); of
    kinds that cannot be fitted those with label 1 (score 1)."""
    kinds = [k for k, _, _ in GENERATORS]
    half = F.pmod(F.xxhash64("id", "row_hash", "start", "kind"), F.lit(2))
    # all candidates, equal ones as one row with their number
    fit = saved(cand.groupBy(half.alias("half"), "kind", "label", *FEATURES).agg(F.count(F.lit(1)).alias("n")), "pii-fit")
    counts = {(r["kind"], r["half"], r["label"]): (r["n"], r["rows"]) for r in fit.groupBy("kind", "half", "label").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()}      # at most 16 rows
    n = lambda *key: counts.get(key, (0, 0))[0]
    fitted = [k for k in kinds if all(n(k, h, y) >= LEAST for h in (0, 1) for y in (0.0, 1.0))]
    unfitted = cand.where(~F.col("kind").isin(*fitted)) if fitted else cand
    chosen = unfitted.where("label = 1").withColumn("score", F.lit(1.0))
    if not fitted:
        return chosen
    fit = fit.where(F.col("kind").isin(*fitted))
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    share = F.create_map(*[F.lit(x) for k in fitted for x in (
        k, min(1.0, MOST_WEIGHT / sum(n(k, h, y) for h in (0, 1) for y in (0.0, 1.0))))])
    # in a fixed order: one partition as long as the distinct rows are few
    parts = 1 + sum(rows for (_, h, _), (_, rows) in counts.items() if h == 0) // _FIT_ROWS
    order = ["kind", "label", *FEATURES]
    learn = fit.where("half = 0").withColumn("weight", F.col("n") * share[F.col("kind")])
    learn = learn.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    trees = GBTClassifier(labelCol="label", featuresCol="features", weightCol="weight", maxIter=10, maxDepth=4,
                          maxBins=_BINS, seed=1)
    model = trees.fit(assemble.transform(learn))

    def scored(df):
        return model.transform(assemble.transform(df)).withColumn(
            "score", F.round(vector_to_array("probability")[1], 4))

    # per kind, from the best score down: the share of right candidates so far
    down = Window.partitionBy("kind").orderBy(F.col("score").desc())
    steps = scored(fit.where("half = 1")).groupBy("kind", "score").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("y"))
    steps = steps.select("kind", "score", (F.sum("y").over(down) / F.sum("n").over(down)).alias("right"))
    limits = {r["kind"]: r["least"] for r in steps.where(F.col("right") >= precision).groupBy("kind").agg(
        F.min("score").alias("least")).collect()}   # one row per kind
    if not limits:
        return chosen
    reaches = reduce(lambda a, b: a | b,
                     [(F.col("kind") == k) & (F.col("score") >= v) for k, v in limits.items()])
    found = scored(cand.where(F.col("kind").isin(*limits))).where(reaches)
    return chosen.unionByName(found.select(*chosen.columns))


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       precision: float = PRECISION) -> DataFrame:
    """``id, row_hash, base, added``: per row of ``docs`` the base spans and the
    spans the trees add, each a sorted array of (start, rank, kind, end).

    Null and empty texts have no spans; a null id stays null; repeated rows get
    the same result each; an empty table gives an empty table. The trees are
    fitted on all candidates of one half (by key hash), the thresholds on all of
    the other, equal feature rows as one with their number; every candidate of a
    fitted kind is scored. The work on a text grows with its length and matches.
    """
    rows = id_and_text(docs, id_col, text_col).select("id", F.xxhash64("text").alias("row_hash"), "text")
    scan = saved(_scanned(rows), "pii")
    doc = ["id", "row_hash"]
    held = scan.where(F.size("cand") > 0).dropDuplicates(doc)
    place = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))
    # one array for every kind: the matches of a pattern are disjoint and in order
    sides = [("base", KINDS[:4]), ("cand", ("hardware", "identity"))]
    apart = F.array(*[F.transform(_only(side, k), place) for side, kinds in sides for k in kinds])
    held = held.withColumn("by", apart).withColumn("steps", _steps(F.col("by")))
    by, steps = F.col("by"), F.col("steps")
    found = held.select(*doc, F.explode(F.transform("cand", lambda c: F.struct(
        c.alias("c"), reduce(lambda x, y: x | y, [_meets(by[k], steps, c) for k in range(4)]).alias("on"),
        (_meets(by[4], steps, c) | _meets(by[5], steps, c)).alias("inside")))).alias("c"))
    found = found.select(*doc, "c.c.*", "c.on", "c.inside")
    cand = saved(_features(_labelled(found)), "pii-candidates")
    chosen = _select(cand, precision).where("not on")

    # of overlapping candidates the best stays; ties: the earlier, then the longer
    rank = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    best = chosen.groupBy(*doc).agg(F.array_sort(F.collect_list(F.struct(
        "start", "end", (-F.col("score")).alias("loss"), rank[F.col("kind")].alias("rank"), "kind"))).alias("all"))
    order = lambda x: F.struct(x["loss"], x["start"], -x["end"], x["rank"])
    apart = F.array(*[_only("all", k) for k, _, _ in GENERATORS])

    def beaten(x, spans, steps):
        first = _how_many(spans, steps, lambda y: y["end"] <= x["start"])
        last = _how_many(spans, steps, lambda y: y["start"] < x["end"])
        return F.exists(F.slice(spans, first + 1, last - first), lambda y: order(y) < order(x))

    best = best.withColumn("by", apart).withColumn("steps", _steps(F.col("by")))
    stays = F.filter("all", lambda x: ~reduce(
        lambda a, b: a | b, [beaten(x, by[k], steps) for k in range(len(GENERATORS))]))
    added = best.select(*doc, F.array_sort(F.transform(
        stays, lambda x: F.struct(x["start"].alias("start"), x["rank"].alias("rank"), x["kind"].alias("kind"),
                                  x["end"].alias("end")))).cast(f"array<{_SPAN}>").alias("added"))
    s, a = scan.alias("s"), added.alias("a")
    empty = F.array().cast(f"array<{_SPAN}>")
    return s.join(a, F.col("s.id").eqNullSafe(F.col("a.id")) & (F.col("s.row_hash") == F.col("a.row_hash")),
                  "left").select("s.id", "s.row_hash", "s.base", F.coalesce("a.added", empty).alias("added"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with every span of ``find_personal_data`` replaced by ``<KIND>``
    in its text; overlapping spans become one, under the first one's kind. All
    columns and rows stay; a null text stays null."""
    spans = find_personal_data(docs, id_col, text_col, **options).dropDuplicates(["id", "row_hash"])
    spans = spans.select("id", "row_hash", F.array_sort(F.concat("base", "added")).alias("spans")).where(
        F.size("spans") > 0)
    text, x = F.col(f"d.{text_col}"), F.col("x.spans")

    def step(acc, s):
        gap = F.when(s["start"] >= acc["at"], F.concat(
            acc["out"], F.substring(acc["piece"], acc["at"] - acc["from"] + 1, s["start"] - acc["at"]),
            F.lit("<"), F.upper(s["kind"]), F.lit(">"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), gap.alias("out"), acc["from"].alias("from"),
                        acc["piece"].alias("piece"), acc["all"].alias("all"))

    def block(acc, spans):
        until = F.array_max(F.transform(spans, lambda s: s["start"]))
        start = F.struct(acc["at"].alias("at"), F.lit("").alias("out"), acc["at"].alias("from"),
                         F.substring(text, acc["at"] + 1, F.greatest(until - acc["at"], F.lit(0))).alias("piece"),
                         acc["all"].alias("all"))
        return F.aggregate(spans, start, step, lambda y: F.struct(
            y["at"].alias("at"), F.array_append(y["all"], y["out"]).alias("all")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("all"))
    done = F.aggregate(_blocks(x), start, block, lambda acc: F.concat(
        F.array_join(acc["all"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    d = docs.alias("d")
    joined = d.join(spans.alias("x"), F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("x.id")) & (
        F.xxhash64(F.coalesce(text.cast("string"), F.lit(""))) == F.col("x.row_hash")), "left")
    return joined.select(*[F.when(x.isNull(), text).otherwise(done).alias(c) if c == text_col else F.col(f"d.{c}")
                           for c in docs.columns])
