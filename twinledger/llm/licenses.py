"""License mentions by ordered signature rules.

A text's words are written apart by two blanks, so that every word has blanks of
its own and a rule for words can stand next to another's. Rules are regular
expressions over such words, made from families of licenses and forms of
mentioning one. A rule is tried only on texts that hold its keyword. Of
overlapping detections, one contained in another of higher priority, or of the
same priority and longer, is suppressed.

Only column functions and joins are used.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The phrases that count alone, and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_CC = "(?:cc|creative commons(?: licen[cs]e)?) {}"
_V = "(?: version| v| ver)?(?: |)"

# Label, keyword, and the name in words, the most specific of a family first.
FAMILIES = (
    ("agpl-3.0", "affero", "(?:gnu )?affero general public licen[cs]e" + _V + "3(?: 0)?"),
    ("agpl-1.0", "affero", "affero general public licen[cs]e" + _V + "1(?: 0)?"),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e"),
    ("lgpl-3.0", "lesser", "gnu lesser general public licen[cs]e" + _V + "3(?: 0)?"),
    ("lgpl-2.1", "lesser", "gnu lesser general public licen[cs]e" + _V + "2 1"),
    ("lgpl-2.0", "library", "gnu library general public licen[cs]e" + _V + "2(?: 0)?"),
    ("lgpl", "lesser", "gnu lesser general public licen[cs]e"),
    ("gpl-3.0", "gnu", "gnu general public licen[cs]e(?: gpl)?" + _V + "3(?: 0)?"),
    ("gpl-2.0", "gnu", "gnu general public licen[cs]e(?: gpl)?" + _V + "2(?: 0)?"),
    ("gpl-1.0", "gnu", "gnu general public licen[cs]e(?: gpl)?" + _V + "1(?: 0)?"),
    ("gpl", "gnu", "gnu general public licen[cs]e"),
    ("gfdl-1.3", "gnu", "gnu free documentation licen[cs]e" + _V + "1 3"),
    ("gfdl", "gnu", "gnu free documentation licen[cs]e"),
    ("apache-2.0", "apache", "apache(?: software)? licen[cs]e" + _V + "2(?: 0)?"),
    ("apache-1.1", "apache", "apache(?: software)? licen[cs]e" + _V + "1 1"),
    ("apache-1.0", "apache", "apache(?: software)? licen[cs]e" + _V + "1 0"),
    ("apache", "apache", "apache(?: software)? licen[cs]e"),
    ("mit", "mit", "(?:the )?mit(?: x11)? licen[cs]e"),
    ("mit-0", "mit", "mit no attribution licen[cs]e"),
    ("x11", "x11", "x11 licen[cs]e"),
    ("isc", "isc", "isc licen[cs]e"),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd licen[cs]e|bsd 4 clause licen[cs]e"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd licen[cs]e|bsd 3 clause licen[cs]e|(?:new|modified|revised) bsd licen[cs]e"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd licen[cs]e|bsd 2 clause licen[cs]e|(?:simplified|freebsd) bsd licen[cs]e"),
    ("0bsd", "bsd", "zero clause bsd"),
    ("0bsd", "0bsd", "0bsd"),
    ("bsd", "bsd", "bsd licen[cs]e"),
    ("mpl-2.0", "mozilla", "mozilla public licen[cs]e" + _V + "2(?: 0)?"),
    ("mpl-1.1", "mozilla", "mozilla public licen[cs]e" + _V + "1 1"),
    ("mpl", "mozilla", "mozilla public licen[cs]e"),
    ("epl-2.0", "eclipse", "eclipse public licen[cs]e" + _V + "2(?: 0)?"),
    ("epl-1.0", "eclipse", "eclipse public licen[cs]e" + _V + "1(?: 0)?"),
    ("epl", "eclipse", "eclipse public licen[cs]e"),
    ("cddl-1.1", "distribution", "common development and distribution licen[cs]e(?: cddl)?" + _V + "1 1"),
    ("cddl", "distribution", "common development and distribution licen[cs]e"),
    ("cpl-1.0", "common", "common public licen[cs]e"),
    ("eupl-1.2", "european", "european union public licen[cs]e" + _V + "1 2"),
    ("eupl", "european", "european union public licen[cs]e"),
    ("artistic-2.0", "artistic", "artistic licen[cs]e" + _V + "2(?: 0)?"),
    ("artistic", "artistic", "artistic licen[cs]e"),
    ("bsl-1.0", "boost", "boost software licen[cs]e"),
    ("busl-1.1", "business", "business source licen[cs]e"),
    ("sspl-1.0", "server", "server side public licen[cs]e"),
    ("zlib", "zlib", "zlib(?: libpng)? licen[cs]e"),
    ("unlicense", "unlicense", "(?:the )?unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("python-2.0", "python", "python(?: software foundation)? licen[cs]e"),
    ("ruby", "ruby", "ruby licen[cs]e"),
    ("php-3.01", "php", "php licen[cs]e"),
    ("postgresql", "postgresql", "postgresql licen[cs]e"),
    ("openssl", "openssl", "openssl licen[cs]e"),
    ("ofl-1.1", "sil", "sil open font licen[cs]e"),
    ("odbl-1.0", "database", "open (?:data commons open )?database licen[cs]e"),
    ("ms-pl", "microsoft", "microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", "microsoft reciprocal licen[cs]e"),
    ("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd-4.0", "nd", _CC.format("by nc nd 4 0")),
    ("cc-by-nc-sa-4.0", "sa", _CC.format("by nc sa 4 0")),
    ("cc-by-nc-4.0", "nc", _CC.format("by nc 4 0")),
    ("cc-by-nd-4.0", "nd", _CC.format("by nd 4 0")),
    ("cc-by-sa-4.0", "sa", _CC.format("by sa 4 0")),
    ("cc-by-4.0", "by", _CC.format("by 4 0")),
    ("cc-by-nc-nd", "nd", _CC.format("by nc nd")),
    ("cc-by-nc-sa", "sa", _CC.format("by nc sa")),
    ("cc-by-nc", "nc", _CC.format("by nc")),
    ("cc-by-nd", "nd", _CC.format("by nd")),
    ("cc-by-sa", "sa", _CC.format("by sa")),
    ("cc-by", "cc", "cc by(?: [0-9] [0-9])?"),
    ("public-domain", "domain", "(?:dedicated to |released into |placed in |in )the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
)

_GRANT = (
    "(?:licen[cs]ed|released|distributed|available|provided|published|covered|shared) (?:to you )?(?:under|by|with) "
    "(?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
)
# Form, its priority, its confidence, its expression; {} stands for the name, [] for the identifier in words.
FORMS = (
    ("identifier", 5, 1.0, "spdx licen[cs]e identifier []"),
    ("grant", 4, 0.95, _GRANT + "(?:{})"),
    ("header", 3, 0.85, "(?:see|under|licen[cs]e|licen[cs]es) (?:the |a |an )?(?:{})"),
    ("name", 2, 0.7, "(?:{})"),
)


#: Every rule's words hold one of these.
HINTS = r"(?i)licen[cs]e|spdx|(?:\b|_)cc|commons|bsd|wtfpl|domain|reserved"


def rules() -> list[tuple[int, str, str, int, float, str]]:
    """(number, label, keyword, priority, confidence, expression) of every rule, families in order."""
    found = []
    for label, keyword, name in FAMILIES:
        for form, priority, confidence, body in FORMS:
            identifier = " ".join("".join(c if c.isalnum() else " " for c in label).split())
            expression = body.replace("{}", name).replace("[]", identifier).replace(" ", "  ")
            gate = "spdx" if form == "identifier" else keyword
            found.append((len(found), label, gate, priority, confidence, f" (?:{expression}) "))
    return found


def spaced_words(text: Column) -> Column:
    """The text's words, each with a blank before and after it; A-Z are lower-cased."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.trim(F.regexp_replace(lower, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", "  "))
    return F.when(words == "", words).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _count(spaced: Column) -> Column:
    """Words in a piece of spaced words."""
    return F.ceil((F.char_length(spaced) - F.char_length(F.replace(spaced, F.lit(" "), F.lit("")))) / 2).cast("long")


def phrase_places(spaced: Column, phrase: str) -> tuple[Column, Column, Column]:
    """How often a phrase's words stand together in spaced words, and the first and last place."""
    literal = " " + phrase.replace(" ", "  ") + " "
    pieces = F.split(spaced, literal, -1)
    there = F.contains(spaced, F.lit(literal))
    number = F.when(there, (F.size(pieces) - 1).cast("long")).otherwise(F.lit(0).cast("long"))
    first = F.when(there, _count(F.element_at(pieces, 1)))
    last = F.when(there, _count(spaced) - _count(F.element_at(pieces, -1)) - len(phrase.split()))
    return number, first, last


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's license mentions, one row per row.

    Returns ``id_col``, ``n_words``, ``n_base`` (places of the base phrases),
    ``first_word`` and ``last_word`` (their first and last place in words from 0, else
    NULL), ``base_labels`` and ``labels`` (sorted arrays; the latter with those of the
    rules that are not suppressed) and ``score``, the highest confidence of a
    detection (0.7 for a base phrase), 0 without one. NULL and empty texts have no
    words. Rows that repeat an id and text have the same result each.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spaced = source.select("id", F.xxhash64("text").alias("hash"), spaced_words(F.col("text")).alias("spaced"))
    places = {label: phrase_places(F.col("spaced"), phrase) for phrase, label in PHRASES.items()}
    counts = [n for n, _, _ in places.values()]
    found = spaced.select(
        "id",
        "hash",
        _count(F.col("spaced")).alias("n_words"),
        sum(counts[1:], counts[0]).alias("n_base"),
        F.least(*(first for _, first, _ in places.values())).alias("first_word"),
        F.greatest(*(last for _, _, last in places.values())).alias("last_word"),
        F.filter(F.array(*(F.when(n > 0, F.lit(label)) for label, (n, _, _) in places.items())), F.isnotnull).alias("base"),
    )
    # few bytes that take much work: dealt to as many tasks as there are partitions, which no coalescing joins
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hinted = source.filter(F.rlike("text", F.lit(HINTS))).withColumn("hash", F.xxhash64("text")).dropDuplicates(["id", "hash"])
    hinted = hinted.repartition(tasks, "id", "hash")
    kept = kept_detections(hinted.select("id", "hash", spaced_words(F.col("text")).alias("spaced")))
    ruled = kept.groupBy(F.col("id").alias("r_id"), F.col("hash").alias("r_hash")).agg(
        F.collect_set("label").alias("ruled"), F.max("confidence").alias("confidence")
    )
    own = F.when(F.size("base") > 0, F.lit(0.7)).otherwise(F.lit(0.0))
    return found.join(
        ruled, F.col("id").eqNullSafe(F.col("r_id")) & F.col("hash").eqNullSafe(F.col("r_hash")), "left"
    ).select(
        F.col("id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_sort("base").alias("base_labels"),
        F.array_sort(F.array_distinct(F.concat("base", F.coalesce("ruled", F.array().cast("array<string>"))))).alias("labels"),
        F.greatest(own, F.coalesce("confidence", F.lit(0.0))).alias("score"),
    )


def rule_table(spark: SparkSession) -> DataFrame:
    names = ("rule", "label", "keyword", "priority", "confidence", "expression")
    every = [F.struct(*(F.lit(value).alias(name) for name, value in zip(names, rule))) for rule in rules()]
    return spark.range(1).select(F.inline(F.array(*every)))


def kept_detections(spaced: DataFrame) -> DataFrame:
    """``id, hash, label, priority, confidence, start, end`` (in words) of detections that nothing suppresses.

    ``spaced`` has ``id``, ``hash`` and the spaced words. The rule table, of fixed
    size, is broadcast; texts without any keyword meet no rule.
    """
    keywords = F.array(*(F.lit(k) for k in sorted({rule[2] for rule in rules()})))
    present = F.filter(keywords, lambda k: F.contains(F.col("spaced"), F.concat(F.lit(" "), k, F.lit(" "))))
    gated = (
        spaced.withColumn("keyword", F.explode_outer(present))
        .join(F.broadcast(rule_table(spaced.sparkSession)), "keyword")
        .filter(F.rlike(F.col("spaced"), F.col("expression")))
    )
    found = F.regexp_extract_all("spaced", "expression", F.lit(0))
    pieces = F.slice(F.split("spaced", F.col("expression"), -1), 1, F.size("found"))
    widths = (
        gated.withColumn("found", found)
        .select(
            "id",
            "hash",
            "rule",
            "label",
            "priority",
            "confidence",
            F.posexplode_outer(F.zip_with(pieces, "found", lambda p, f: F.struct(_count(p).alias("skip"), _count(f).alias("long")))),
        )
        .filter("pos IS NOT NULL")
    )
    so_far = Window.partitionBy("id", "hash", "rule").orderBy("pos")
    ends = F.sum(F.col("col.skip") + F.col("col.long")).over(so_far)
    spans = widths.select(
        "id", "hash", "rule", "label", "priority", "confidence", (ends - F.col("col.long")).alias("start"), ends.alias("end")
    )
    wider = Window.partitionBy("id", "hash").orderBy("start", F.desc("end"), F.desc("priority"), "rule").rowsBetween(
        Window.unboundedPreceding, -1
    )
    reach = {p: F.max(F.when(F.col("priority") >= p, F.col("end"))).over(wider) for p in sorted({f[1] for f in FORMS})}
    over = F.coalesce(*(F.when(F.col("priority") == p, line) for p, line in reach.items()))
    return (
        spans.withColumn("over", over)
        .filter(F.col("over").isNull() | (F.col("over") < F.col("end")))
        .select("id", "hash", "label", "priority", "confidence", "start", "end")
    )


