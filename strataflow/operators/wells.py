"""Identification of a log file's well: by its id, else by fields and the names a well may be written in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity, text
from .records import name_variants

#: Least similarity of a field's name, and of a well's.
FIELD_LEAST, WELL_LEAST = 60.0, 85.0


def field_candidates(words: DataFrame, fields: DataFrame, least: float = FIELD_LEAST) -> DataFrame:
    """word, field_id, field_code, field_score: the fields (field_id, name, code) that a word may mean, each with its best score.

    An equal code, in any case, scores 100; a similar name its ratio over sorted words.
    """
    by_code = words.join(fields.select("field_id", "code"), F.upper("word") == F.upper("code")).select("word", "field_id", F.lit(100.0).alias("score"), F.lit(0).alias("kind"))
    named = fields.select("field_id", similarity.sorted_tokens(F.upper("name")).alias("field_plain"))
    plain = words.withColumn("word_plain", similarity.sorted_tokens(F.col("word")))
    by_name = similarity.similar_pairs(plain, named, "word_plain", "field_plain", least).select("word", "field_id", F.col("ratio").alias("score"), F.lit(1).alias("kind"))
    best = by_code.union(by_name).groupBy("word", "field_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "kind")).alias("best"))
    return best.join(fields.select("field_id", F.col("code").alias("field_code")), "field_id").select("word", "field_id", "field_code", (-F.col("best.s")).alias("field_score"), F.col("best.kind").alias("field_kind"))


def _preferred(candidates: Column, suffix_wanted: Column) -> Column:
    """Of wells in order (assigned ones first, then by id), the one that a pass with replacement ends at.

    A better score replaces; of equal scores, where both the file and the well have a suffix, one that is longer
    or comes after a name without brackets.
    """
    none = F.lit(None).cast("struct<unassigned:boolean,well_id:bigint,well:string,score:double>")

    def keep(best: Column, new: Column) -> Column:
        tie = (new["score"] == best["score"]) & suffix_wanted & text.has_suffix(new["well"]) & (~F.contains(best["well"], F.lit("(")) | (F.length(new["well"]) > F.length(best["well"])))
        return F.when(best.isNull() | (new["score"] > best["score"]) | tie, new).otherwise(best)

    return F.aggregate(candidates, none, keep)


def identify_wells(files: DataFrame, wells: DataFrame, fields: DataFrame, least: float = WELL_LEAST) -> DataFrame:
    """file_id, well_id, method ('uwi' or 'name') and score of each file (file_id, name, uwi) whose well is found.

    ``wells`` has well_id, name, field_id (or null) and uwi. A file's id decides where a well has it. Else its name's parts give
    candidate fields, best first; in each the names that the well may have are compared with the field's wells
    and those without field of the same number, and the first field with a hit wins. Equal names are looked up once, and wells
    meet names by number, so no name is compared with all wells.
    """
    known = wells.filter("uwi <> ''").groupBy(F.upper("uwi").alias("_uwi")).agg(F.min("well_id").alias("well_id"))
    by_uwi = files.filter("uwi <> ''").join(known, F.upper("uwi") == F.col("_uwi")).select("file_id", "well_id", F.lit("uwi").alias("method"), F.lit(100.0).alias("score"))
    rest = files.join(by_uwi.select("file_id"), "file_id", "left_anti")
    parts = rest.select(text.well_name(F.col("name")).alias("plain")).filter("plain <> ''").distinct().withColumn("p", text.name_parts(F.col("plain"))).filter("p.number is not null")
    parts = parts.withColumn("word", F.coalesce("p.field", "p.code"))
    candidates = parts.join(field_candidates(parts.select("word").distinct(), fields), "word")
    candidates = candidates.withColumn("names", name_variants(F.coalesce(F.nullif("field_code", F.lit("")), F.col("p.code")), F.col("p.number"), F.col("p.suffix"), F.col("p.field")))
    listed = wells.select("well_id", F.col("name").alias("well"), F.col("field_id").alias("well_field"), text.first_number(F.col("name")).alias("number"), similarity.sorted_tokens(text.well_name(F.col("name"))).alias("well_plain"))
    wanted = candidates.select("plain", "field_id", "field_score", "field_kind", F.col("p.number").alias("number"), F.col("p.suffix").isNotNull().alias("has_suffix"), F.explode("names").alias("variant")).withColumn("variant", similarity.sorted_tokens(F.col("variant")))
    shared = ["plain", "field_id", "field_score", "field_kind", "has_suffix", "variant", "well_id", "well", "well_plain", "unassigned"]
    inside = wanted.join(listed.filter("well_field is not null").withColumnRenamed("well_field", "field_id"), ["number", "field_id"]).withColumn("unassigned", F.lit(False)).select(*shared)
    outside = wanted.join(listed.filter("well_field is null").drop("well_field"), "number").withColumn("unassigned", F.lit(True)).select(*shared)
    pairs = inside.union(outside).filter(similarity.can_reach(F.col("variant"), F.col("well_plain"), least))
    scored = pairs.withColumn("score", similarity.similarity("variant", "well_plain")).filter(F.col("score") >= least)
    per_well = scored.groupBy("plain", "field_id", "field_score", "field_kind", "has_suffix", "unassigned", "well_id", "well").agg(F.max("score").alias("score"))
    per_field = per_well.groupBy("plain", "field_id", "field_score", "field_kind", "has_suffix").agg(F.array_sort(F.collect_list(F.struct("unassigned", F.col("well_id").cast("long").alias("well_id"), "well", "score"))).alias("found"))
    place = F.row_number().over(Window.partitionBy("plain").orderBy(F.desc("field_score"), "field_kind", "field_id"))
    best = per_field.withColumn("_place", place).filter("_place = 1").select("plain", _preferred(F.col("found"), F.col("has_suffix")).alias("best"))
    by_name = rest.withColumn("plain", text.well_name(F.col("name"))).join(best, "plain").select("file_id", F.col("best.well_id").alias("well_id"), F.lit("name").alias("method"), F.col("best.score").alias("score"))
    return by_uwi.union(by_name)


def refined_entry(x: Column) -> Column:
    """A well's name as the pattern search takes it: without marks of the kind of well before it and dashes behind it."""
    plain = F.regexp_replace(F.trim(F.upper(x)), r"(?U)^(T/P|T-P|C/D|C-D|[A-Z]{1,2}/[A-Z]{1,2})\s+", "")
    plain = F.regexp_replace(F.replace(plain, F.lit("/"), F.lit("-")), r"(?U)[^\w\s.\-()]", "")
    return F.regexp_replace(text.collapse(F.regexp_replace(plain, r"(?U)\s*-\s*", "-")), "-+$", "")


def wells_by_pattern(files: DataFrame, wells: DataFrame, fields: DataFrame) -> DataFrame:
    """file_id, well_id, rank of each file (file_id, name, uwi) that a well's id or name fits.

    Ranks: 0 the same id; in the fields of the name's code, by id, 1 the very name 'CODE-number', 2 a name that begins with it,
    and, for names with a letter beside the code or behind the number, 3 a name of the form 'CODE...-number...'. Of a code of
    four letters that no field has, the last is such a letter. Of several wells the least id counts. Wells meet
    names by field and by what their numbers behind a dash begin with, which each of the forms needs.
    """
    known = wells.filter("uwi <> ''").groupBy(F.col("uwi").alias("_uwi")).agg(F.min("well_id").alias("well_id"))
    by_uwi = files.filter("uwi <> ''").join(known, F.col("uwi") == F.col("_uwi")).select("file_id", "well_id", F.lit(0).alias("rank"))
    rest = files.join(by_uwi.select("file_id"), "file_id", "left_anti").withColumn("entry", refined_entry(F.col("name")))
    form = r"([A-Z.()]+)[\s\-]+(\d+)(?:[(\s\-/]*([A-Z]))?\.?\)?$"
    names = rest.select("entry").distinct().select("entry", F.translate(F.regexp_extract("entry", form, 1), "-()", "").alias("whole"), F.regexp_extract("entry", form, 2).alias("number"), (F.regexp_extract("entry", form, 3) != "").alias("behind")).filter("number <> '' and whole <> ''")
    codes = fields.filter("code <> ''").select("field_id", "code", F.upper("code").alias("_code"))
    names = names.join(codes.select("_code").distinct().withColumn("listed", F.lit(True)), F.col("whole") == F.col("_code"), "left").drop("_code")
    cut = (F.length("whole") == 4) & F.col("listed").isNull()
    names = names.select("entry", "number", "behind", cut.alias("cut"), F.when(cut, F.substring("whole", 4, 1)).alias("letter"), F.when(cut, F.substring("whole", 1, 3)).otherwise(F.col("whole")).alias("_code"))
    names = names.join(codes, "_code").withColumn("refined", F.concat("code", F.when(F.col("cut"), F.concat(F.lit("."), "letter")).otherwise(""), F.lit("-"), "number"))
    runs = F.flatten(F.transform(F.regexp_extract_all("name", F.lit(r"-(\d+)"), F.lit(1)), lambda d: F.transform(F.sequence(F.lit(1), F.length(d)), lambda i: F.substring(d, F.lit(1), i))))
    listed = wells.filter("field_id is not null").select("well_id", F.col("name").alias("well"), "field_id", F.explode(F.array_distinct(runs)).alias("number"))
    pairs = names.join(listed, ["field_id", "number"])
    loose = (F.col("cut") | F.col("behind")) & F.startswith(F.col("well"), F.col("code")) & F.contains(F.expr("substring(well, length(code) + 1)"), F.concat(F.lit("-"), F.col("number")))
    rank = F.when(F.col("well") == F.col("refined"), 1).when(F.startswith(F.col("well"), F.col("refined")), 2).when(loose, 3)
    found = pairs.withColumn("rank", rank).filter("rank is not null").groupBy("entry").agg(F.min(F.struct("field_id", "rank", "well_id")).alias("best"))
    return by_uwi.union(rest.join(found, "entry").select("file_id", F.col("best.well_id"), F.col("best.rank")))


def entry_name(x: Column) -> Column:
    """A raw name in upper case, with blanks for what is no letter, digit or one of _ - . ( )."""
    return text.collapse(F.regexp_replace(F.replace(F.upper(x), F.lit("Ñ"), F.lit("N")), r"(?U)[^\w\s\-.()]", " "))


def compared_name(x: Column) -> Column:
    """A name as it is compared: without brackets and dots, dashes without blanks, one half of a name that says the same twice."""
    plain = F.regexp_replace(F.replace(F.upper(x), F.lit("Ñ"), F.lit("N")), "[().]", " ")
    plain = F.regexp_replace(F.regexp_replace(plain, r"(?U)[^\w\s\-]", ""), r"(?U)\s*-\s*", "-")
    return text.without_half(plain)


def _bare(x: Column, around: str = r"[ .\-()]") -> Column:
    return F.regexp_replace(x, f"^{around}+|{around}+$", "")


def _entries(names: DataFrame, fields: DataFrame) -> DataFrame:
    """name, number, ending, main, code, middle, field_text of each distinct raw name: its parts, as far as the fields' codes tell."""
    form = r"^(.*?)(?:[\s\-]|(?=\d))(\d+)(?:[\s(\-/]*([A-Z]))?\.?\)?$"
    plain = F.col("plain")
    whole, first = plain.rlike(form), text.first_number(plain)
    before = F.expr("substring(plain, 1, length(plain) - instr(reverse(plain), reverse(first)) - length(first) + 1)")
    rows = names.select("name", entry_name(F.col("name")).alias("plain")).withColumn("first", first)
    rows = rows.select(
        "name", F.when(whole, F.regexp_extract(plain, form, 2)).otherwise(F.col("first")).alias("number"), F.when(whole, F.nullif(F.regexp_extract(plain, form, 3), F.lit(""))).alias("ending"),
        F.when(whole, _bare(F.regexp_extract(plain, form, 1))).when(F.col("first").isNotNull(), _bare(before)).otherwise(plain).alias("main"),
    )
    code = F.trim(F.translate("main", "()", ""))
    split = r"^([A-Z]{2,3})[\s.]?([A-Z0-9])$"
    short = lambda c: c.rlike(r"^[\p{L}\p{N}]{2,4}$") & ~c.rlike(r"^\p{N}+$")
    none = F.lit(None).cast("string")
    option = lambda i, fits, c, middle: F.when(fits, F.struct(F.lit(i).alias("i"), c.alias("code"), middle.alias("middle")))
    compact = F.replace(code, F.lit(" "))
    options = F.array_compact(F.array(
        option(1, F.contains(code, F.lit(" ")) & short(compact), compact, none), option(2, short(code), code, none), option(3, code.rlike(split), F.regexp_extract(code, split, 1), F.regexp_extract(code, split, 2)),
        option(4, (F.length(code) == 4) & short(code), F.substring(code, 1, 3), F.substring(code, 4, 1)),
    ))
    known = fields.filter("code <> ''").groupBy(F.upper("code").alias("_code")).agg(F.min_by("field", "field_id").alias("field_text"))
    tried = rows.select("name", F.explode(options).alias("o")).join(known, F.upper("o.code") == F.col("_code"))
    best = tried.groupBy("name").agg(F.min_by(F.struct("o.code", "o.middle", "field_text"), "o.i").alias("b"))
    found = rows.join(best, "name", "left")
    return found.select("name", "number", "ending", "main", F.col("b.code").alias("code"), F.col("b.middle").alias("middle"), F.when(F.col("b").isNotNull(), F.col("b.field_text")).otherwise(F.col("main")).alias("field_text"))


def _by_words(words: DataFrame, fields: DataFrame, least: float) -> DataFrame:
    """word, field_id, score by sets of words. Pairs that share a word meet by it, others by the likeness of their sorted words, which is their score then."""
    unique = lambda c: F.array_join(F.array_sort(F.array_distinct(F.filter(F.split(c, r"\s+"), lambda w: w != ""))), " ")
    a = words.select("word", compared_name(F.col("word")).alias("a")).filter("a <> ''").withColumn("a_words", unique(F.col("a")))
    b = fields.filter("field <> ''").select("field_id", compared_name(F.col("field")).alias("b")).withColumn("b_words", unique(F.col("b")))
    sharing = a.withColumn("w", F.explode(F.split("a_words", " "))).join(b.withColumn("w", F.explode(F.split("b_words", " "))), "w").select("word", "a", "field_id", "b").distinct()
    alike = similarity.similar_pairs(a, b, "a_words", "b_words", least).select("word", "a", "field_id", "b")
    scored = sharing.union(alike).distinct().withColumn("score", similarity.set_similarity("a", "b"))
    return scored.filter(F.col("score") >= least).select("word", "field_id", "score")


def identify_wells_by_words(files: DataFrame, wells: DataFrame, fields: DataFrame, field_least: float = 60.0, well_least: float = WELL_LEAST) -> DataFrame:
    """file_id, well_id, method and score as ``identify_wells`` has them, by another way of reading names.

    The fields' codes (field_id, field, code) tell how a name is split: all of it without blanks, all of it, a code and a letter, or three
    letters and one. Fields are those of the code and those with similar sets of words. Names are written with
    the field's code, its name, its initials and what the file has, and compared with the field's own wells of the same
    number by sets of words; the best score wins, then the first name, then the least well; the best field with a hit counts.
    """
    known = wells.filter("uwi <> ''").groupBy(F.upper("uwi").alias("_uwi")).agg(F.min("well_id").alias("well_id"))
    by_uwi = files.filter(F.trim("uwi") != "").join(known, compared_name(F.col("uwi")) == F.col("_uwi")).select("file_id", "well_id", F.lit("uwi").alias("method"), F.lit(100.0).alias("score"))
    rest = files.filter(F.trim("name") != "").join(by_uwi.select("file_id"), "file_id", "left_anti")
    parts = _entries(rest.select("name").distinct(), fields).filter("number is not null")
    by_code = parts.filter("code is not null").join(fields.filter("code <> ''").select("field_id", F.upper("code").alias("_code")), F.upper("code") == F.col("_code")).select("name", "field_id", F.lit(100.0).alias("score"), F.lit(0).alias("kind"))
    words = F.coalesce(F.nullif("field_text", F.lit("")), F.col("code"))
    texts = parts.withColumn("word", words).filter("word <> ''")
    by_text = texts.join(_by_words(texts.select("word").distinct(), fields, field_least), "word").select("name", "field_id", "score", F.lit(1).alias("kind"))
    candidates = by_code.union(by_text).groupBy("name", "field_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "kind")).alias("c"))
    rows = candidates.join(parts, "name").join(fields.select("field_id", "field", F.col("code").alias("own_code")), "field_id")

    number = F.concat("number", F.coalesce("ending", F.lit("")))
    code = F.upper(F.coalesce(F.nullif(F.trim("own_code"), F.lit("")), F.nullif(F.trim("code"), F.lit(""))))
    title, raw = F.nullif(compared_name(F.coalesce(F.nullif(F.trim("field"), F.lit("")), F.col("field_text"))), F.lit("")), F.nullif(compared_name(F.col("field_text")), F.lit(""))
    initials = F.array_join(F.filter(F.transform(F.split(title, " "), lambda w: F.substring(w, 1, 1)), lambda c: c.rlike(r"^[\p{L}\p{N}]$")), "")
    with_middle = lambda c: F.when(F.col("middle").isNotNull(), F.array(F.concat(c, F.lit("."), "middle", F.lit("-"), number), F.concat(c, "middle", F.lit("-"), number))).otherwise(F.array(F.concat(c, F.lit("-"), number)))
    no = F.array().cast("array<string>")
    made = F.concat(
        F.when(code.isNotNull(), with_middle(code)).otherwise(no), F.when(title.isNotNull(), F.array(F.concat(title, F.lit("-"), number))).otherwise(no),
        F.when((initials != "") & (code.isNull() | (initials != code)), with_middle(initials)).otherwise(no),
        F.when(raw.isNotNull() & (raw != F.coalesce(code, F.lit(""))) & (raw != F.coalesce(title, F.lit(""))), F.array(F.concat(raw, F.lit("-"), number))).otherwise(no),
    )
    tidy = F.transform(F.array_compact(made), lambda n: F.replace(F.replace(F.regexp_replace(F.trim(n), r"\s*-\s*", "-"), F.lit(".-"), F.lit("-")), F.lit(". -"), F.lit("-")))
    more = F.concat(F.array(compared_name(F.col("name"))), F.when(F.col("code").isNotNull(), with_middle(F.col("code"))).otherwise(no), F.when((F.coalesce("field_text", F.lit("")) != "") & (compared_name(F.col("field_text")) != F.coalesce(compared_name(F.col("field")), F.lit(""))), F.array(F.concat(compared_name(F.col("field_text")), F.lit("-"), number))).otherwise(no))
    tried = rows.select("name", "field_id", "c", "number", F.explode(F.array_distinct(F.concat(tidy, F.array_compact(more)))).alias("variant")).withColumn("a", compared_name(F.col("variant"))).filter("a <> ''")
    listed = wells.filter("field_id is not null").select("well_id", "field_id", text.first_number(F.col("name")).alias("number"), compared_name(F.col("name")).alias("b")).filter("b <> ''")
    scored = tried.join(listed, ["field_id", "number"]).withColumn("score", similarity.set_similarity("a", "b")).filter(F.col("score") >= well_least)
    per_field = scored.groupBy("name", "field_id", "c").agg(F.min(F.struct((-F.col("score")).alias("s"), "variant", "well_id")).alias("w"))
    best = per_field.groupBy("name").agg(F.min_by("w", F.struct("c.s", "c.kind", "field_id")).alias("w"))
    return by_uwi.union(rest.join(best, "name").select("file_id", F.col("w.well_id"), F.lit("name"), -F.col("w.s")))
