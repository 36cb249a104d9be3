"""Personal data in texts: spans of fixed kinds, and spans that boosted trees select.

Base spans (email, ip, card, phone) follow fixed patterns and checks. Beside them,
high-recall generators propose overlapping candidates: spelled-out addresses, longer
digit groups, and assigned keys. Gradient-boosted trees judge a candidate by its format
and the text around it. They are trained on a bounded sample of distinct candidates, as
many of each generator and class, marked by
whether a base span or, where none covers it, the candidate's own form and cue words
confirm it (``confirmed``; the checks themselves, such as the digit sum, are no features).
Per generator, the lowest threshold at which the candidates that could be added (those no
base span covers) reach ``PRECISION`` selects the spans that are added: how many candidates
base spans cover doesn't move it. All distinct candidates but the trained ones are scored
for it, each class weighing what it weighs in the whole. A generator that never reaches it
adds nothing.

DataFrame functions and Spark ML only. A pattern is applied twice to a text, once for the
matches and once for what lies between; running lengths give the places.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segmint.llm.common import resized, store

#: base kinds in the order of their listing; the patterns are the fixed ones, written so that a long run is scanned once:
#: possessive where no way back can match, and started only where a run starts or the match before ended
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = {
    "contact": r"(?i)(?:(?<![a-z0-9._%+-])|\G)[a-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[a-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[a-z0-9-]++)++",
    "number": r"[0-9](?:[\x20().\/-]{0,2}[0-9]){6,40}+",
    "secret": r"""(?i)(?:token|secret|passwd|password|api[_-]?key)\x20{0,3}[:=]\x20{0,3}["']?[a-z0-9+/_=-]{8,}+""",
}
KINDS = [*BASE, *GENERATORS]
CUES = {"cue_contact": r"(?i)mail|contact|write|@", "cue_number": r"(?i)card|phone|tel|call|fax|\bid\b|account|iban|visa|ssn|\bno\.?\s*$", "cue_address": r"(?i)\bip\b|host|server|address",
        "cue_assign": r"[:=]\s*[\"']?$", "before_word": r"[\p{L}]$", "before_digit": r"[0-9][^\p{L}]{0,2}$", "before_table": r"\|\s*$"}
#: what confirms a candidate that no base span covers; an address's form holds its last label to letters and its dots to no spaces
ADDRESS_CUE, PHONE_CUE = r"(?i)mail|contact|write|reach", r"(?i)\b(?:phone|tel|call|fax|mobile|cell|whatsapp)"
AT, DOT, LOOSE_DOT = r"(?i)\x20?(?:@|\(at\)|\[at\])\x20?", r"(?i)\x20?(?:\.|\(dot\)|\[dot\])\x20?", r"\.\x20|\x20\."
SAMPLE = 6000
PRECISION = 0.9
CONTEXT = 24
TREES, DEPTH, SEED = 20, 4, 7
#: classes the sample is drawn from in equal bounds: covered, confirmed and other candidates of two generators, confirmed and other keys
CLASSES = 8
BINS = 10_000


def _found(text: Column, kind: str, pattern: str) -> Column:
    """Matches with the text in front of and behind each, and the kind."""
    hit, gap = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    rows = F.transform(F.arrays_zip(hit.alias("hit"), F.slice(gap, 1, F.size(hit)).alias("gap"), F.slice(gap, 2, F.size(hit)).alias("behind")),
                       lambda m: F.struct(F.lit(kind).alias("kind"), m["hit"].alias("hit"), F.char_length(m["gap"]).alias("gap"),
                                          F.right(m["gap"], F.lit(CONTEXT)).alias("before"), F.left(m["behind"], F.lit(CONTEXT)).alias("after")))
    return rows


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the digit sum with every second digit from the right doubled is a multiple of ten."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((d.cast("int") * 2) % 10 + F.floor(d.cast("int") * 2 / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda s, d: s + F.coalesce(d, F.lit(0))) % 10 == 0


def passes(kind: Column, hit: Column) -> Column:
    """The checks of the base kinds."""
    digits = _digits(hit)
    n = F.length(digits)
    ip = F.forall(F.split(hit, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))) <= 3) & F.forall(
        F.split(hit, r"\."), lambda p: F.coalesce(F.right(p, F.lit(4)).try_cast("int"), F.lit(0)) <= 255)
    return (F.when(kind == "email", True).when(kind == "ip", ip).when(kind == "card", F.when(n.between(14, 19), luhn(digits)).otherwise(False))
            .when(kind == "phone", n.between(10, 15)).otherwise(True))


def matches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every match of every pattern with its place, and for each row one row of kind null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    hint = {"email": F.col("text").contains("@"), "contact": F.col("text").rlike(r"(?i)@|[(\[]at[)\]]"), "phone": F.col("text").contains("+"),
            "secret": F.col("text").rlike(r"(?i)token|secret|passw|api")}
    shape = "array<struct<kind:string,hit:string,gap:int,before:string,after:string>>"
    lists = [F.when(hint.get(k, F.col("text").rlike("[0-9]")), _found(F.col("text"), k, p)).cast(shape) for k, p in {**BASE, **GENERATORS}.items()]
    none = F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("hit"), F.lit(0).alias("gap"), F.lit("").alias("before"), F.lit("").alias("after"))).cast(shape)
    empty = F.array().cast(shape)
    each = plain.select("row", "doc_id", F.xxhash64("text").alias("key"), F.posexplode(F.concat(none, *[F.coalesce(x, empty) for x in lists])).alias("at", "m"))
    so_far = Window.partitionBy("row", "m.kind").orderBy("at")
    end = F.sum(F.col("m.gap") + F.char_length("m.hit")).over(so_far)
    return each.withColumn("end", end).select("row", "doc_id", "key", "m.kind", "m.hit", "m.before", "m.after", (F.col("end") - F.char_length("m.hit")).alias("start"), "end")


def features(spans: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context features of candidates."""
    count = lambda p: F.regexp_count("hit", F.lit(p)).cast("double")
    made = {"f_length": F.char_length("hit").cast("double"), "f_digits": count("[0-9]"), "f_letters": count(r"\p{L}"), "f_spaces": count(r"\x20"), "f_dots": count(r"\."),
            "f_dashes": count("-"), "f_brackets": count(r"[()\[\]]"), "f_groups": count("[0-9]+"), "f_longest": F.array_max(F.transform(F.split("hit", "[^0-9]+"), F.length)).cast("double"),
            "f_at": count("@"), "f_distinct": F.size(F.array_distinct(F.split("hit", ""))).cast("double"), "f_first": F.ascii("hit").cast("double"),
            "f_after_sign": F.col("after").rlike(r"^[^\s.,;\p{L}]").cast("double"), "f_after_word": F.col("after").rlike(r"^\p{L}").cast("double"), "f_plus": F.col("before").endswith("+").cast("double"),
            "f_loose": F.col("hit").rlike(LOOSE_DOT).cast("double"), "f_cue_address_word": F.col("before").rlike(ADDRESS_CUE).cast("double"), "f_cue_phone": F.col("before").rlike(PHONE_CUE).cast("double")}
    made |= {f"f_{name}": F.col("before").rlike(p).cast("double") for name, p in CUES.items()}
    made |= {f"f_{k}": (F.col("kind") == k).cast("double") for k in GENERATORS}
    return spans.withColumns(made), list(made)


def _with_base(spans: DataFrame) -> DataFrame:
    """Candidates with ``sure``: whether a passed base span overlaps them (1 or 0). Sweeps each row's spans by start."""
    ok = spans.where(F.col("kind").isNotNull()).withColumn("base", F.col("kind").isin(*BASE)).where(~F.col("base") | F.coalesce(passes(F.col("kind"), F.col("hit")), F.lit(False)))
    reach = F.when(F.col("base"), F.col("end"))
    back = Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    first = F.when(F.col("base"), F.col("start"))
    return ok.withColumn("_reach", F.max(reach).over(back)).withColumn("_next", F.min(first).over(ahead)).withColumn(
        "sure", (F.coalesce(F.col("_reach") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_next") < F.col("end"), F.lit(False))).cast("int")).drop("_reach", "_next")


def confirmed(kind: Column, hit: Column, before: Column) -> Column:
    """Whether a candidate's own form and cue words confirm it, without a base span.

    contact: it reads as an address once its signs are put in, and its at is spelled in brackets
    or a cue word stands before it. number: a phone's digits behind a cue word, or a card's in
    other groups than a card's, with their sum. secret: its value mixes letters and digits.
    """
    address = F.regexp_replace(F.regexp_replace(hit, AT, "@"), DOT, ".").rlike(r"^[A-Za-z0-9._%+-]*[A-Za-z0-9]@.*\.[A-Za-z]{2,24}$") & ~hit.rlike(LOOSE_DOT)
    digits = _digits(hit)
    n = F.length(digits)
    phone = n.between(10, 15) & before.rlike(PHONE_CUE)
    card = F.when(n.between(14, 19), luhn(digits)).otherwise(False)
    return (F.when(kind == "contact", address & (hit.rlike(r"(?i)[(\[]at[)\]]") | before.rlike(ADDRESS_CUE))).when(kind == "number", phone | card)
            .otherwise(hit.rlike(r"[0-9]") & hit.rlike(r"^[^:=]*+[:=].*[A-Za-z]")))


def _labelled(spans: DataFrame) -> DataFrame:
    """Candidates with ``covered`` (a passed base span overlaps them) and ``sure`` (that, or ``confirmed``; of keys only the latter), each 1 or 0."""
    own = F.coalesce(confirmed(F.col("kind"), F.col("hit"), F.col("before")), F.lit(False)).cast("int")
    return spans.withColumn("covered", F.col("sure")).withColumn("sure", F.when((F.col("kind") != "secret") & (F.col("covered") == 1), 1).otherwise(own))


def find_personal(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE, precision: float = PRECISION) -> DataFrame:
    """Rows (row, doc_id, key, kind, start, end, score): every selected span, and per row of
    ``docs`` one row of kind null. ``key`` is the text's 64-bit hash; places count code points,
    the end exclusive.

    At most ``sample`` distinct candidates train the trees, whatever the input's size, and of each
    generator and class at most an eighth of them; counts and thresholds of everything else cover
    all rows. Null and empty texts have no spans; repeated rows and null
    ids are treated like any other row; other columns are not read.
    """
    spans = store(matches(docs, id_col, text_col))
    checked = store(_with_base(spans))
    base = checked.where("base").select("row", "doc_id", "key", "kind", "start", "end", F.lit(1.0).alias("score"))
    none = spans.where("kind is null").select("row", "doc_id", "key", "kind", "start", "end", F.lit(0.0).alias("score"))
    of = ["key", "kind", "start"]  # copies of a text hold the same candidates
    labelled = _labelled(checked.where("not base")).withColumn("draw", F.xxhash64(*of))
    # a candidate that a base span covers already adds nothing
    addable = (F.col("kind") == "secret") | (F.col("covered") == 0)
    labelled = labelled.withColumn("class", F.when(addable, F.col("sure")).otherwise(2))
    bound = max(sample // CLASSES, 2)
    rank = F.row_number().over(Window.partitionBy("kind", "class").orderBy("draw"))
    drawn = store(labelled.dropDuplicates(of).withColumn("rank", rank).where(F.col("rank") <= bound))
    train, names = features(drawn.where("rank % 4 <> 1"))
    if {r["sure"] for r in train.select("sure").distinct().collect()} != {0, 1}:  # nothing to learn from
        return base.union(none)
    put = VectorAssembler(inputCols=names, outputCol="features")
    model = GBTClassifier(labelCol="sure", maxIter=TREES, maxDepth=DEPTH, seed=SEED).fit(put.transform(train))
    scored = store(model.transform(put.transform(features(labelled.where(addable))[0])).withColumn("score", vector_to_array("probability")[1])
                   .select("row", "doc_id", *of, "end", "score", "class", "draw", F.floor(F.col("score") * BINS).alias("bin")))
    trained = drawn.where("rank % 4 <> 1").select(F.col("kind").alias("_kind"), F.col("draw").alias("_draw"))
    held = scored.dropDuplicates(of).join(F.broadcast(trained), (F.col("kind") == F.col("_kind")) & (F.col("draw") == F.col("_draw")), "left")
    bins = held.groupBy("kind", "class", "bin").agg(F.count("*").alias("all"), F.count(F.when(F.col("_draw").isNull(), 1)).alias("n"))
    whole = Window.partitionBy("kind", "class")
    above = Window.partitionBy("kind").orderBy(F.desc("bin")).rangeBetween(Window.unboundedPreceding, 0)
    weight = F.col("n") * F.sum("all").over(whole) / F.sum("n").over(whole)
    cuts = (bins.withColumn("weight", weight).where("n > 0").withColumn("right", F.sum(F.col("weight") * F.col("class")).over(above) / F.sum("weight").over(above))
            .where(F.col("right") >= precision).groupBy("kind").agg(F.min("bin").alias("cut")).collect())  # one row per generator
    chosen = F.lit(False)
    for r in cuts:
        chosen = chosen | ((F.col("kind") == r["kind"]) & (F.col("bin") >= r["cut"]))
    added = scored.where(chosen).select("row", "doc_id", "key", "kind", "start", "end", "score")
    return base.union(added).union(none)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind)


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of each row."""
    listed = F.sort_array(F.collect_list(F.when(F.col("kind").isNotNull(), F.struct("start", _order(F.col("kind")).alias("o"), "end", "kind"))))
    rows = found.groupBy("row", "doc_id").agg(listed.alias("all"))
    of_base = F.filter("all", lambda s: s["kind"].isin(*BASE))
    n = lambda k: F.size(F.filter("all", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select("doc_id", *[n(k) for k in BASE], F.sha2(_joined(of_base), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with every span's text replaced by its kind in brackets; overlapping spans become one
    of the first's kind. All columns stay, ``size_col`` is counted anew where it is there."""
    spans = found.where("kind is not null").select("doc_id", "key", "kind", "start", "end").distinct()
    order = Window.partitionBy("doc_id", "key").orderBy("start", _order(F.col("kind")))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    island = F.sum(F.when(F.col("start") < F.col("_reach"), 0).otherwise(1)).over(order)
    merged = (spans.withColumn("_reach", F.max("end").over(before)).withColumn("_island", island).groupBy("doc_id", "key", "_island")
              .agg(F.min("start").alias("a"), F.max("end").alias("b"), F.min_by("kind", F.struct("start", _order(F.col("kind")))).alias("kind")))
    cuts = merged.groupBy("doc_id", "key").agg(F.sort_array(F.collect_list(F.struct("a", "b", "kind"))).alias("cuts"))
    # the documents' own columns stay inside one struct, so their names can't clash with these
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("hash"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("key")), "left")
    text = F.col("doc")[text_col]
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda c: c["b"]))
    parts = F.transform("cuts", lambda c, i: F.concat(text.substr((F.element_at(starts, i + 1) + 1).cast("int"), (c["a"] - F.element_at(starts, i + 1)).cast("int")),
                                                      F.lit("["), F.upper(c["kind"]), F.lit("]")))
    tail = text.substr((F.element_at(starts, -1) + 1).cast("int"), F.char_length(text))
    new = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.concat_ws("", parts), tail))
    return resized(joined.select(*[(new if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns]), text_col, size_col)
