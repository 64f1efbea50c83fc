"""Credit lines: names, people, companies and what waits for an editor."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import slugify, split_credit_line
from .link import name_keys

#: Patterns (fixed values): what joins two halves of one name, and particles before a surname.
JOINED = r"(?iu)^\s*(&|and|und|et|y|og|och|e|en)\s*$"
BORROWS = r"(?iu)^\s*(&|\+|and|et|und|y|og|och|e|en)\s*$"
PARTICLE = r"(?iu)^(de|van|von|di|da|del|della|de la|le|la|du|des|van der|van den|ter|ten|af|av)\s+\S+$"


def credit_parts(lines: DataFrame) -> DataFrame:
    """The parts of each line in order: ``(line_id, name, pos, part, next, between, n_parts)``; ``between`` is the text
    from this part to the next as the line has it."""
    rows = lines.select(F.col("id").alias("line_id"), "name", split_credit_line(F.col("name")).alias("parts"))
    rows = rows.select("line_id", "name", "parts", F.size("parts").alias("n_parts"), F.posexplode("parts").alias("pos", "part")).withColumn("next", F.get("parts", F.col("pos") + 1))
    at, to = F.instr("name", F.col("part")), F.instr("name", F.col("next"))
    between = F.when((at > 0) & (to > at), F.substr(F.col("name"), at + F.length("part"), to - at - F.length("part")))
    return rows.select("line_id", "name", "pos", "part", "next", between.alias("between"), "n_parts")


def rebuild_credits(lines: DataFrame, people: DataFrame, companies: DataFrame, decisions: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Resolve the parts of credit lines: ``(parts, lines)``.

    parts: line_id, pos, part, status, member_id, company_id, candidates. Resolution in this order: an editor's decision
    (line_id, part, member_id), where a null member leaves the part out; a company written "A & B", which takes the next part too; a person by name or alias; a
    company; a surname (one word or a particle and a word, slug of 3 or more) that one person bears; "First and First
    Surname" borrows the surname; a full name that splits into itself is a new person ``new:<slug>``; the rest waits as
    ``unresolved`` with candidates. A line whose one part is the line itself is a person. lines: line_id, kind, member_ids,
    company_ids, in order. All lookups are joins on slugs, a row for each part.
    """
    rows = credit_parts(lines).withColumn("slug", slugify(F.col("part"))).withColumn("pair", slugify(F.concat(F.col("part"), F.lit(" & "), F.col("next"))))
    can_borrow = ~F.col("part").rlike(r"\s") & F.col("next").rlike(r"\s") & F.coalesce(F.col("between").rlike(BORROWS), F.lit(False))
    rows = rows.withColumn("borrowed", F.when(can_borrow, slugify(F.concat(F.col("part"), F.lit(" "), F.regexp_replace("next", r"^\S+\s+", "")))))
    person, company = name_keys(people), name_keys(companies)
    by = lambda df, keys, col, out: df.join(keys.select(F.col("slug").alias("_k"), F.col("id").cast("string").alias(out)), F.col(col) == F.col("_k"), "left").drop("_k")
    rows = by(by(by(by(rows, person, "slug", "by_person"), company, "slug", "by_company"), company, "pair", "by_pair"), person, "borrowed", "by_borrowed")
    # endings of two or more words of each person's slug, so a surname is an equi join
    words = F.split("slug", "-")
    last = name_keys(people.withColumn("aliases", F.lit(None).cast("array<string>"))).select(F.col("id").cast("string").alias("pid"), "slug", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - 1, F.lit(1))), lambda n: F.array_join(F.slice(words, n + 1, F.size(words)), "-"))).alias("ending")).where("ending <> ''")
    endings = last.groupBy("ending").agg(F.array_sort(F.collect_set("pid")).alias("bearers"))
    is_surname = ~F.col("part").rlike(r"\s") | F.col("part").rlike(PARTICLE)
    rows = rows.join(endings, (F.col("slug") == F.col("ending")) & is_surname & (F.length("slug") >= 3), "left").withColumn("surname", is_surname)
    if decisions is not None:
        d = decisions.select(F.col("line_id").alias("_l"), F.col("part").alias("_p"), F.col("member_id").cast("string").alias("decided"), F.lit(True).alias("settled"))
        rows = rows.join(d, (F.col("line_id") == F.col("_l")) & (F.col("part") == F.col("_p")), "left").drop("_l", "_p")
    else:
        rows = rows.withColumn("decided", F.lit(None).cast("string")).withColumn("settled", F.lit(None).cast("boolean"))
    paired = F.col("by_pair").isNotNull() & F.col("settled").isNull() & F.coalesce(F.col("between").rlike(JOINED), F.lit(False))
    rows = rows.withColumn("paired", paired)
    # a pair takes its next part, which then cannot begin a pair itself: alternate inside runs of pairs
    w = Window.partitionBy("line_id").orderBy("pos")
    rows = rows.withColumn("_run", F.sum((~F.col("paired")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    rows = rows.withColumn("_nth", F.row_number().over(Window.partitionBy("line_id", "_run", "paired").orderBy("pos")))
    rows = rows.withColumn("starts", F.col("paired") & (F.col("_nth") % 2 == 1))
    rows = rows.withColumn("taken", F.coalesce(F.lag("starts").over(w), F.lit(False)))
    whole = (F.col("n_parts") == 1) & (F.col("slug") == slugify(F.col("name")))
    clean = split_credit_line(F.col("part"))
    new = ~F.col("surname") & (F.size(clean) == 1) & (slugify(F.get(clean, F.lit(0))) == F.col("slug"))
    one = F.size("bearers") == 1
    status = (
        F.when(F.col("taken"), "in pair").when(whole, "self").when(F.col("settled"), "decided").when(F.col("starts"), "company").when(F.col("slug") == "", "ignored")
        .when(F.col("by_person").isNotNull(), "person").when(F.col("by_company").isNotNull(), "company").when(one, "person").when(F.col("by_borrowed").isNotNull(), "person")
        .when(new, "new person").when(F.col("borrowed").isNotNull(), "new person").otherwise("unresolved")
    )
    member = F.when(status == "self", F.col("line_id").cast("string")).when(status == "decided", F.col("decided")).when(status == "person", F.coalesce("by_person", F.when(one, F.get("bearers", F.lit(0))), "by_borrowed")).when(status == "new person", F.concat(F.lit("new:"), F.when(new, F.col("slug")).otherwise(F.col("borrowed"))))
    firm = F.when(status == "company", F.when(F.col("starts"), F.col("by_pair")).otherwise(F.col("by_company")))
    parts = rows.select("line_id", "pos", "part", status.alias("status"), member.alias("member_id"), firm.alias("company_id"), F.when(status == "unresolved", F.coalesce("bearers", F.array().cast("array<string>"))).alias("candidates"))
    ordered = lambda c: F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("pos", c)))), lambda x: x[c]))
    built = parts.groupBy("line_id").agg(F.when(F.max(F.col("status") == "self"), "person").otherwise("credit_line").alias("kind"), ordered("member_id").alias("member_ids"), ordered("company_id").alias("company_ids"))
    return parts, built


def resolve_credit_parts(decisions: DataFrame, people: DataFrame, lines: DataFrame, companies: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply an editor's picks ``(line_id, part, member_id)``: ``(people with new aliases, parts, lines)`` of the touched lines.

    A part that is a full name (two words or more) becomes an alias of the picked person; a null pick leaves the part out."""
    new = decisions.where(F.col("member_id").isNotNull() & F.col("part").rlike(r"\S\s+\S")).groupBy(F.col("member_id").alias("_m")).agg(F.array_sort(F.collect_set("part")).alias("_new"))
    named = people.join(new, F.col("id") == F.col("_m"), "left").withColumn("aliases", F.array_union(F.coalesce("aliases", F.array().cast("array<string>")), F.coalesce("_new", F.array().cast("array<string>")))).drop("_m", "_new")
    touched = lines.join(decisions.select(F.col("line_id").alias("id")).distinct(), "id", "left_semi")
    parts, built = rebuild_credits(touched, named, companies, decisions)
    return named, parts, built


def company_fallback(performances: DataFrame, lines: DataFrame) -> DataFrame:
    """Empty companies filled from the first company of the performance's credit line."""
    l = lines.select(F.col("line_id").cast("string").alias("_l"), F.get("company_ids", F.lit(0)).alias("_c"))  # noqa: E741
    out = performances.join(l, F.col("choreographer_id").cast("string") == F.col("_l"), "left")
    return out.withColumn("company_id", F.coalesce(F.col("company_id").cast("string"), F.col("_c"))).drop("_l", "_c")


def protected_ids(performances: DataFrame, choreographers: DataFrame, sources: DataFrame) -> DataFrame:
    """Ids of performances that must not be removed: a protected person credited, or a core company source by id or by name.

    All are equi joins, and performances are read once. The name of a core company source inside a company's name is found
    among the distinct names' parts of its length; lengths of core names are few.
    """
    guarded = choreographers.where("protected").select(F.col("id").alias("_g")).where("_g is not null").distinct()
    core = sources.where((F.col("priority") == 0) & F.col("kind").rlike("(?i)company"))
    firms = core.select(F.col("company_id").alias("_c")).where("_c is not null").distinct().withColumn("_core", F.lit(True))
    names = core.select(F.lower("name").alias("_n")).where("_n <> ''").distinct().withColumn("_len", F.length("_n"))
    lengths = names.select("_len").distinct()
    called = performances.select(F.lower("company_name").alias("_name")).where("_name is not null").distinct()
    parts = called.join(F.broadcast(lengths), F.length("_name") >= F.col("_len"))
    parts = parts.select("_name", "_len", F.explode(F.transform(F.sequence(F.lit(1), F.length("_name") - F.col("_len") + 1), lambda i: F.substr("_name", i, F.col("_len")))).alias("_n"))
    named = parts.join(names, ["_len", "_n"]).select("_name").distinct().withColumn("_by_name", F.lit(True))
    ids = performances.schema["member_ids"].dataType
    who = F.array_compact(F.array_append(F.coalesce("member_ids", F.array().cast(ids)), F.col("choreographer_id").cast(ids.elementType)))
    rows = performances.select("id", F.col("company_id").alias("_c"), F.lower("company_name").alias("_name"), who.alias("_who"))
    rows = rows.join(firms, "_c", "left").join(named, "_name", "left")
    by_company = F.col("_core").isNotNull() | F.col("_by_name").isNotNull()
    # a row that its company protects needs no person
    people = F.when(by_company, F.array(F.lit(None).cast(ids.elementType))).otherwise(F.array_distinct("_who"))
    rows = rows.select("id", by_company.alias("_kept"), F.explode(people).alias("_g")).join(guarded.withColumn("_person", F.lit(True)), "_g", "left")
    return rows.where(F.col("_kept") | F.col("_person").isNotNull()).select("id").distinct()
