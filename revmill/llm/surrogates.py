"""Personal data replaced by surrogates, with DataFrame functions only.

Detected entities get keyed replacements of the same type and form. The same entity has one surrogate in all texts, two
entities never share one, and no surrogate is an entity that the texts hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import remove, stage, table

# Titles by gender, in several languages and two scripts; the name after one is a person.
TITLES = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Señora", "Sra", "Madame", "Mme", "Signora", "Госпожа", "Г-жа"),
    "m": ("Mr", "Herr", "Señor", "Sr", "Monsieur", "Signor", "Господин", "Г-н"),
}
# Syllables of made-up names, and the endings that mark a gender.
SYLLABLES = {
    "latin": ("ba", "ce", "do", "fi", "ga", "he", "jo", "ki", "lu", "ma", "ne", "po", "ra", "si", "to", "va"),
    "cyrillic": ("ба", "ве", "до", "фи", "га", "же", "зо", "ки", "лу", "ма", "не", "по", "ра", "си", "то", "ва"),
    "greek": ("βα", "γε", "δο", "φι", "κα", "λε", "μο", "νι", "πα", "ρε", "σο", "τι", "ζα", "θε", "ξο", "χι"),
    "armenian": ("բա", "գե", "դո", "զի", "թա", "լե", "խո", "կի", "հա", "մե", "նո", "շի", "պա", "ռե", "սո", "տի"),
}
ENDINGS = {
    "latin": {"f": "lina", "m": "rik"}, "cyrillic": {"f": "лина", "m": "рик"},
    "greek": {"f": "λινα", "m": "ρικ"}, "armenian": {"f": "լինա", "m": "րիկ"},
}

NAME = r"\p{Lu}[\p{L}'’-]+(?: \p{Lu}[\p{L}'’-]+)?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
    r"|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9])[0-9]{4}(?:([ -]?)[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])",
    "secret": r"(?i:(?<=\b(?:token|secret|password|passwd|api_key|apikey|api-key) {0,2}[=:] {0,2}[\"']))"
    r"[A-Za-z0-9+/_.=-]{8,}(?=[\"'])",
    "person": "(?iu:(?<![\\p{L}])(?:" + "|".join(t for g in TITLES.values() for t in g) + "))\\.? " + NAME,
}
ANY = "|".join(PATTERNS[k] for k in ("email", "secret", "phone", "ip", "card", "person"))
GATE = "[0-9@\"']"  # every entity but a person holds one of these
RETRIES = 64
ROOM = 8  # attempts after which mails grow and secrets take any letter or digit in any place


def _may_hold(text: Column) -> Column:
    """True for every text that matches ANY, and cheap: the long pattern need not read the others."""
    out = text.rlike(GATE)
    low = F.lower(text)
    for title in (t for g in TITLES.values() for t in g):
        out = out | low.contains(title.lower())
    return out


def _kind(value: Column) -> Column:
    whole = {k: f"^(?:{p})$" for k, p in PATTERNS.items()}
    out = F.when(value.rlike(whole["email"]), "email").when(value.rlike(whole["ip"]), "ip")
    out = out.when(value.rlike(whole["phone"]), "phone").when(value.rlike(whole["card"]), "card")
    return out.when(value.rlike(whole["person"]), "person").otherwise("secret")


def _title(value: Column) -> Column:
    return F.substring_index(value, " ", 1)


def _name(value: Column) -> Column:
    return F.substring(value, F.length(_title(value)) + 2, F.length(value))


def _canonical(kind: Column, value: Column) -> Column:
    """What two mentions of one entity have in common: no case, for numbers no punctuation, for persons gender and name."""
    title = F.lower(F.regexp_replace(_title(value), r"\.", ""))
    gender = F.when(title.isin([t.lower() for t in TITLES["f"]]), "f").otherwise("m")
    script = F.lit("latin")
    for own in ("Armenian", "Greek", "Cyrillic"):
        script = F.when(_name(value).rlike(rf"\p{{Is{own}}}"), own.lower()).otherwise(script)
    return (
        F.when(kind.isin("phone", "card"), F.regexp_replace(value, "[^0-9]", ""))
        .when(kind == "person", F.concat_ws("|", gender, script, F.lower(_name(value))))
        .otherwise(F.lower(value))
    )


def _byte(at: str) -> str:
    """SQL for a number from 0 to 255 out of the entity's keyed stream of 64 bytes."""
    return f"cast(conv(substring(stream, 2 * pmod({at}, 64) + 1, 2), 16, 10) as int)"


def _each(chars: str, rule: str) -> str:
    """SQL that rewrites a string character by character; rule sees c and its place i, from 0."""
    return (
        f"array_join(transform(sequence(0, length({chars}) - 1), i -> "
        f"(transform(array(substring({chars}, i + 1, 1)), c -> {rule}))[0]), '')"
    )


def _surrogate() -> Column:
    """The surrogate, in canonical form, from kind, entity and stream."""
    letter = f"char(97 + pmod({_byte('i')}, 26))"
    digit = f"char(48 + pmod({_byte('i')}, 10))"
    hexed = f"char(97 + pmod({_byte('i')}, 6))"
    top = "length(substring_index(entity, '.', -1))"
    email = _each(
        "entity",
        f"case when i >= length(entity) - {top} then c when c rlike '[a-z]' then {letter} "
        f"when c rlike '[0-9]' then {digit} else c end",
    )
    # Short mails have few surrogates of their length.
    grown = f"transform(sequence(1, attempt - {ROOM - 1}), i -> char(97 + pmod({_byte('i + 40')}, 26)))"
    email = f"concat(case when attempt < {ROOM} then '' else array_join({grown}, '') end, {email})"
    mark = f"substring('+/_.=-', 1 + pmod({_byte('i')}, 6), 1)"
    secret = _each(
        "entity",
        f"case when attempt >= {ROOM} then substring('abcdefghijklmnopqrstuvwxyz0123456789', 1 + pmod({_byte('i')}, 36), 1) "
        f"when not entity rlike '[a-z0-9]' then {mark} when c rlike '[a-f]' and entity rlike '^[a-f0-9]+$' then {hexed} when c rlike '[a-z]' then {letter} "
        f"when c rlike '[0-9]' then {digit} else c end",
    )
    ip = "concat_ws('.', " + ", ".join(f"1 + pmod({_byte(str(i))}, 254)" for i in range(4)) + ")"
    # Country and area code groups stay plausible: a first digit is never 0 unless it was.
    digits = _each(
        "entity",
        f"case when kind = 'phone' and i < length(entity) - 10 then c when i = 0 and kind = 'card' then c "
        f"when c = '0' and i = 0 then c when i = 0 or kind = 'phone' and i = length(entity) - 10 then char(50 + pmod({_byte('i')}, 8)) "
        f"else {digit} end",
    )
    # A number that passed the Luhn check goes on passing it.
    card = (
        f"case when luhn_check(entity) then (transform(array(substring({digits}, 1, length(entity) - 1)), s -> "
        "concat(s, cast(filter(sequence(0, 9), d -> luhn_check(concat(s, cast(d as string))))[0] as string))))[0] "
        f"else {digits} end"
    )

    # As many words as the name has. The first grows with the attempts, so there are names for any number of entities.
    def name(script: str, gender: str) -> str:
        own = "array(" + ", ".join(f"'{s}'" for s in SYLLABLES[script]) + ")"

        def word(first: int, last: str) -> str:
            syllable = f"{own}[pmod({_byte(f'i + {first}')}, {len(SYLLABLES[script])})]"
            return f"concat(array_join(transform(sequence(0, {last}), i -> {syllable}), ''), '{ENDINGS[script][gender]}')"

        return f"concat({word(0, '4 + attempt')}, case when entity like '% %' then concat(' ', {word(40, '2')}) else '' end)"

    person = "concat(substring_index(entity, '|', 2), '|', case substring_index(entity, '|', 2) " + " ".join(
        f"when '{g}|{s}' then {name(s, g)}" for s in SYLLABLES for g in ("f", "m")
    ) + " end)"
    return F.expr(
        f"case kind when 'email' then {email} when 'ip' then {ip} when 'phone' then {digits} when 'card' then {card} "
        f"when 'person' then {person} else {secret} end"
    )


def _in_form_of() -> Column:
    """The surrogate written as the mention was: its case, its punctuation, its title."""
    cased = (
        "array_join(transform(sequence(1, length(value)), i -> case when substring(value, i, 1) rlike '[A-Z]' "
        "then upper(substring(surrogate, i, 1)) else substring(surrogate, i, 1) end), '')"
    )
    cased = f"concat({cased}, substring(surrogate, length(value) + 1, length(surrogate)))"
    before = "length(regexp_replace(substring(value, 1, i), '[^0-9]', ''))"
    spaced = (
        "array_join(transform(sequence(1, length(value)), i -> case when substring(value, i, 1) rlike '[0-9]' "
        f"then substring(surrogate, {before}, 1) else substring(value, i, 1) end), '')"
    )
    title = "substring_index(value, ' ', 1)"
    new = "substring_index(surrogate, '|', -1)"
    person = (
        f"concat({title}, ' ', case when value = upper(value) then upper({new}) else initcap({new}) end)"
    )
    return F.expr(
        f"case when kind in ('phone', 'card') then {spaced} when kind = 'person' then {person} "
        f"when kind = 'ip' then surrogate else {cased} end"
    )


def surrogate_table(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate) for distinct (kind, entity): keyed, all different, and none an entity itself.

    Where two entities draw one surrogate, the smaller entity keeps it and the others draw again; so does
    whatever draws an entity of the input. Rounds go on until no collision is left. Mails, secrets and names get more room as
    attempts grow; numbers and addresses of a fixed length cannot, and raise an error if they hold nearly all of their form.
    """
    stream = F.concat(*(F.sha2(F.concat_ws("\u0001", F.lit(key), "kind", "entity", "attempt", F.lit(i)), 256) for i in (0, 1)))

    def drawn(df: DataFrame) -> DataFrame:
        return stage(df.withColumn("stream", stream).withColumn("surrogate", _surrogate()).drop("stream"), "surrogates")

    now = drawn(entities.withColumn("attempt", F.lit(0)))
    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    for _ in range(RETRIES):
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n"))
        clash = first.join(real, ["kind", "surrogate"], "left").where("n > 1 OR real")
        if clash.isEmpty():
            return now.drop("attempt")
        again = now.join(clash, ["kind", "surrogate"], "left").select(
            "kind", "entity",
            (F.col("attempt") + F.when(F.col("real") | (F.col("entity") != F.col("first.entity")), 1).otherwise(0)).alias("attempt"),
        )
        following = drawn(again)
        remove(now)
        now = following
    raise ValueError("too few surrogates for the entities of a kind")


def replace_entities(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced, kinds) of every row; text has surrogates in the place of personal data.

    Kinds: e-mail and IPv4 addresses, phone and card numbers, quoted secrets after their names, and names after titles.
    Everything else stays as it is; texts without entities are passed on. A null text stays null, an empty one empty.
    Mentions that differ in case or punctuation only are one entity. Rows that repeat are rewritten alike; other columns
    are not read. Only texts with entities are written to the shared folder and joined with their surrogates; an entity
    that very many texts hold is one row of the surrogate table, and Spark splits the large side of that join.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    any_entity = F.coalesce(_may_hold(F.col("text")) & F.col("text").rlike(ANY), F.lit(False))
    held = stage(rows.where(any_entity), "entity-texts").select(
        "doc_id", "text", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    mentions = held.select(
        "file", "row", F.posexplode(F.regexp_extract_all("text", F.lit(ANY), F.lit(0))).alias("i", "value")
    )
    mentions = mentions.withColumn("kind", _kind(F.col("value")))
    mentions = stage(mentions.withColumn("entity", _canonical(F.col("kind"), F.col("value"))), "mentions")
    known = surrogate_table(mentions.select("kind", "entity").distinct(), key)
    written = mentions.join(known, ["kind", "entity"]).withColumn("out", _in_form_of())
    per_text = written.groupBy("file", "row").agg(
        F.array_sort(F.collect_list(F.struct("i", "out"))).alias("found"),
        F.array_sort(F.collect_set("kind")).alias("kinds"),
    )
    pieces = F.split("text", ANY, -1)
    rewritten = held.join(per_text, ["file", "row"]).withColumn("pieces", pieces).select(
        "doc_id",
        F.concat(
            F.array_join(F.zip_with(F.slice("pieces", 1, F.size("found")), "found", lambda p, f: F.concat(p, f["out"])), ""),
            F.element_at("pieces", -1),
        ).alias("text"),
        F.size("found").cast("long").alias("n_replaced"),
        "kinds",
    )
    plain = rows.where(~any_entity).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_replaced"), F.array().cast("array<string>").alias("kinds")
    )
    return plain.unionByName(rewritten)


def op5_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents"), key="revmill-surrogates")
