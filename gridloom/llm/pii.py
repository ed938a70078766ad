"""Operator 8: personal data and secrets replaced by keyed surrogates, native.

Entities are found by one pattern. Each distinct entity of the corpus gets one surrogate, drawn by
a keyed hash in the entity's own format: letters stay letters of their script and case (vowels
stay vowels), digits stay digits, separators stay. Names are found by a title before them or an honorific
after them, and again wherever the same text has them without one. They keep their ending and the
title, so the gender shown by either stays. Surrogates are checked against each other and against
all entities found; those that clash are drawn again. So one entity has one surrogate everywhere,
two entities never share one, and no surrogate is somebody else's entity.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.llm.tables import released, written

#: Titles that stand before a name, with or without a full stop.
TITLES = (
    "Mr", "Mrs", "Ms", "Mx", "Miss", "Dr", "Doctor", "Prof", "Professor", "Sir", "Dame", "Rev", "Herr", "Herrn", "Frau",
    "Monsieur", "Madame", "Mme", "Mlle", "Señor", "Señora", "Señorita", "Sr", "Sra", "Srta", "Signor", "Signora", "Sig", "Dott",
    "Г-н", "Г-жа", "господин", "госпожа", "Κύριος", "Κυρία", "מר", "גברת", "السيد", "السيدة", "الدكتور", "श्री", "श्रीमती",
)
#: Honorifics behind a name.
HONORIFICS = ("さん", "様", "씨")
_TITLE = "|".join(TITLES)
_PART = r"(?:\p{Lu}[\p{L}\p{M}]+|\p{Lo}[\p{Lo}\p{M}]+)"
_HEX = "[0-9A-Fa-f]{1,4}"
SECRET_NAMES = "password|passwd|pwd|passphrase|token|secret|api_?key|access_?key|auth"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": rf"(?<=[=:\"']|[=:]\s{{1,3}})(?<=\b(?i:{SECRET_NAMES})[\"']?\s{{0,3}}[=:]\s{{0,3}}[\"']?)[A-Za-z0-9_/+.-]{{7,}}[A-Za-z0-9_/+-]",
    "credential": r"\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?<![\d\p{L}])(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}|\(\d{3}\) ?\d{3}-\d{4})(?!\d)",
    "national_phone": r"(?<![\d\p{L}.,+-])(?:[2-9]\d{2}(?:-\d{3}-|\.\d{3}\.)\d{4}|0\d{2,4}[ -]\d{3,4}[ -]\d{3,4})(?![.,-]?\d)",
    "card": r"(?<![\d.])(?:\d{4}(?:[ -]\d{4}){3}|\d{13,19})(?!\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d)",
    "ip6": rf"(?<![\p{{L}}\d:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\p{{L}}\d:])",
    "name": rf"(?=[\p{{Lu}}\p{{Lo}}])(?<= )(?<=(?<![\p{{L}}\p{{M}}])(?:{_TITLE})\.? )(?!(?:{_TITLE})(?![\p{{L}}\p{{M}}])){_PART}(?:[ -]\p{{Lu}}[\p{{L}}\p{{M}}]+)?",
    "honoured": r"(?:(?<!\p{IsHan})\p{IsHan}{1,4}(?=さん|様)|(?<![가-힣])[가-힣]{2,4}(?= ?씨(?![가-힣])))",
}
#: Alphabets of exchange: a letter becomes one of its own row.
ROWS = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâäãåèéêëìíîïòóôöõùúûü", "çñß", "ÀÁÂÄÃÅÈÉÊËÌÍÎÏÒÓÔÖÕÙÚÛÜ", "ÇÑ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщъь", "АЕЁИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψς", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
#: First and last code points of the blocks whose other letters are exchanged too.
BLOCKS = ((0x00C0, 0x024F), (0x0370, 0x058F), (0x05D0, 0x07FF), (0x0900, 0x0EFF), (0x1000, 0x10FF), (0x1200, 0x135A), (0x1780, 0x17B3), (0x1E00, 0x1EFF))
#: First and last code point of scripts with many letters.
RANGES = ((0x05D0, 0x05EA), (0x0627, 0x064A), (0x0915, 0x0939), (0x3041, 0x3093), (0x30A1, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
#: Draws before a surrogate may be longer than its entity, and before giving up.
PLAIN_DRAWS, MOST_DRAWS = 8, 64


def _other_rows() -> list[tuple[str, str]]:
    """Letters of BLOCKS that no row of ROWS has, by script, case and vowel: those to exchange, and
    those to draw from (of cased letters the ones with a letter of the other case)."""
    groups: dict[tuple, str] = {}
    for low, high in BLOCKS:
        for ch in map(chr, range(low, high + 1)):
            sort = unicodedata.category(ch)
            if sort in ("Lu", "Ll", "Lo") and not any(ch in row for row in ROWS):
                vowel = sort != "Lo" and unicodedata.normalize("NFD", ch)[0].lower() in "aeiouyаеиоуыэюяαεηιουω"
                group = unicodedata.name(ch).split(" ")[0], sort, vowel
                groups[group] = groups.get(group, "") + ch

    def paired(ch: str) -> bool:
        other = ch.upper() if ch.islower() else ch.lower()
        back = other.lower() if ch.islower() else other.upper()
        return other != ch == back and len(other) == 1 and any(low <= ord(other) <= high for low, high in BLOCKS)

    return [(row, "".join(filter(paired, row)) or row) for row in groups.values()]


def pattern() -> str:
    return "|".join(PATTERNS.values())


def found_by(text: Column) -> Column:
    """The pattern for one text: the general one, and the names that it finds wherever they recur."""
    titled = F.regexp_extract_all(text, F.lit(PATTERNS["name"]), F.lit(0))
    # The longest first, so that no part of a name is taken for it.
    names = F.array_sort(F.array_distinct(titled), lambda x, y: F.length(y) - F.length(x))
    again = F.concat(F.lit(pattern() + r"|(?<![\p{L}\p{M}\p{N}])(?:"), F.array_join(names, "|"), F.lit(r")(?![\p{L}\p{M}\p{N}])"))
    return F.when(F.size(names) > 0, again).otherwise(pattern())


def has_entity(text: Column) -> Column:
    """Whether the pattern is found; texts without a figure, sign or title cannot have one, and
    are told by cheap searches."""
    hint = text.rlike("[0-9@=:]")
    for word in [*(t + end for t in TITLES for end in (" ", ". ")), *HONORIFICS]:
        hint = hint | text.contains(word)
    return F.coalesce(hint & F.regexp_like(text, F.lit(pattern())), F.lit(False))


def kind(m: Column) -> Column:
    """The type an entity is drawn as, from its own letters alone."""
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(r"^(\d{1,3}\.){3}\d{1,3}$"), "ip")
        .when(m.rlike(r"^[+(0-9][0-9 ().+-]*$"),
              F.when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn").when(m.rlike(r"^[+(]") | (digits < 13), "phone").otherwise("card"))
        .when(m.rlike(rf"^{_HEX}:[0-9A-Fa-f:]+$"), "ip6")
        .when(m.rlike(rf"^{_PART}([ -]\p{{Lu}}[\p{{L}}\p{{M}}]+)?$|^\p{{Lo}}$"), "name")
        .otherwise("secret")
    )


def canonical(m: Column, typ: Column) -> Column:
    """What makes two spellings one entity: digits of numbers, lower case of addresses and names."""
    return F.when(typ.isin("phone", "card", "ssn"), F.regexp_replace(m, "[^0-9]", "")).when(typ.isin("email", "name", "ip6"), F.lower(m)).otherwise(m)


_OTHER = _other_rows()


def _masked(text: str, sub: str, keep_first: str = "0", keep_last: str = "0") -> str:
    """SQL for ``text`` with each letter and digit drawn anew from its alphabet by ``sub``."""
    cases = "".join(
        f" WHEN contains('{row}', ch) THEN substr('{row}', CAST(pmod(xxhash64({sub}, i), {len(row)}) AS INT) + 1, 1)" for row in ROWS
    )
    for low, high in RANGES:
        at = f"lpad(hex({low} + pmod(xxhash64({sub}, i), {high - low + 1})), 4, '0')"
        cases += f" WHEN ch BETWEEN '{chr(low)}' AND '{chr(high)}' THEN decode(unhex({at}), 'UTF-16BE')"
    for row, drawn_from in _OTHER:
        cases += f" WHEN contains('{row}', ch) THEN substr('{drawn_from}', CAST(pmod(xxhash64({sub}, i), {len(drawn_from)}) AS INT) + 1, 1)"
    return (
        f"array_join(transform(split({text}, ''), (ch, i) -> CASE WHEN i < {keep_first} OR i >= length({text}) - {keep_last} THEN ch"
        f"{cases} ELSE ch END), '')"
    )


def drawn(key: str) -> Column:
    """Surrogate of the columns typ, c and attempt, as long as c (longer after PLAIN_DRAWS)."""
    quoted = key.replace("\\", "\\\\").replace("'", "\\'")
    sub = f"sha2(concat_ws('\u0001', '{quoted}', typ, c, attempt), 256)"
    domain = f"sha2(concat_ws('\u0001', '{quoted}', 'domain', substring_index(c, '@', -1)), 256)"
    longer = f"IF(attempt < {PLAIN_DRAWS}, '', array_join(transform(sequence(1, attempt - {PLAIN_DRAWS - 1}), j -> substr('{{row}}', CAST(pmod(xxhash64({sub}, -j), {{n}}) AS INT) + 1, 1)), ''))"
    letters, digits = longer.format(row="aeionrst", n=8), longer.format(row="0123456789", n=10)
    host = "substring_index(c, '@', -1)"
    labels = f"substr({host}, 1, length({host}) - length(substring_index({host}, '.', -1)))"
    return F.expr(
        f"""CASE typ
        WHEN 'email' THEN concat({_masked("substring_index(c, '@', 1)", sub)}, {letters}, '@', {_masked(labels, domain)}, substring_index({host}, '.', -1))
        WHEN 'ip' THEN array_join(transform(sequence(0, 3), i -> CAST(1 + pmod(xxhash64({sub}, i), 254) AS STRING)), '.')
        WHEN 'ip6' THEN IF(attempt < {PLAIN_DRAWS},
          array_join(transform(split(c, ''), (ch, i) -> IF(ch = ':', ch, lower(hex(pmod(xxhash64({sub}, i), 16))))), ''),
          array_join(transform(sequence(0, 7), i -> lower(hex(4096 + pmod(xxhash64({sub}, i), 61440)))), ':'))
        WHEN 'name' THEN concat({letters}, {_masked("c", sub, keep_last="IF(length(substring_index(c, ' ', -1)) >= 5, 2, 0)")})
        WHEN 'phone' THEN concat({_masked("c", sub, keep_first="1")}, {digits})
        WHEN 'card' THEN concat({_masked("c", sub, keep_first="1")}, {digits})
        ELSE concat({_masked("c", sub)}, {digits}) END"""
    )


def poured() -> Column:
    """Surrogate s in the format of the spelling m: its separators, its capitals."""
    return F.expr(
        """CASE
        WHEN typ IN ('phone', 'card', 'ssn') THEN concat(
          array_join(transform(split(m, ''), (ch, i) -> IF(ch BETWEEN '0' AND '9', substr(s, length(regexp_replace(substr(m, 1, i + 1), '[^0-9]', '')), 1), ch)), ''),
          substr(s, length(c) + 1))
        WHEN typ IN ('email', 'name') AND length(s) = length(m) THEN
          array_join(transform(split(m, ''), (ch, i) -> IF(ch <> lower(ch), upper(substr(s, i + 1, 1)), substr(s, i + 1, 1))), '')
        WHEN typ = 'name' THEN initcap(s)
        ELSE s END"""
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(typ, c, s) for distinct (typ, c): keyed, distinct per type, and never an entity found.

    Draws are repeated, with the draw's number in the hash, for those that clash; of several that
    meet at one surrogate the smallest entity keeps it.
    """
    known = entities.select("typ", "c")
    table = written(entities.withColumn("attempt", F.lit(0)).withColumn("s", drawn(key)), "surrogates")
    for _ in range(MOST_DRAWS):
        holder = table.groupBy("typ", "s").agg(F.min("c").alias("holder"), F.count("*").alias("n")).where("n > 1").drop("n")
        taken = known.withColumnRenamed("c", "s").withColumn("taken", F.lit(True))
        clash = table.join(holder, ["typ", "s"], "left").join(taken, ["typ", "s"], "left")
        again = F.coalesce("taken", F.lit(False)) | (F.col("holder").isNotNull() & (F.col("holder") != F.col("c")))
        clash = clash.select("typ", "c", "attempt", "s", again.alias("again"))
        if clash.where("again").isEmpty():
            return table.select("typ", "c", "s")
        fresh = clash.where("again").select("typ", "c", (F.col("attempt") + 1).alias("attempt")).withColumn("s", drawn(key))
        spent, table = table, written(clash.where("NOT again").drop("again").unionByName(fresh), "surrogates")
        released(spent)
    raise ValueError("no distinct surrogates: too many entities for their format")


def pseudonymised(documents: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``documents`` with surrogates in ``text``; other columns stay, ``n_replaced`` is added.

    Texts without entities, empty and null texts come back as they are (0 replaced). Repeated rows
    come back each, with the same surrogates. An existing column ``n_replaced`` is overwritten.
    Only texts with entities are joined, on a digest of the text; the others do not move. Other columns may have
    any name. Numbers of one telephone with and without its country's code are two entities.
    """
    names = [c for c in documents.columns if c.lower() != "n_replaced"]
    documents = documents.select(*[f"`{c}`" for c in names])
    body = F.col(f"`{text}`")
    has = has_entity(body)
    found = documents.where(has).select(F.md5(body.cast("binary")).alias("h"), F.regexp_extract_all(body, found_by(body), F.lit(0)).alias("all"))
    found = found.groupBy("h").agg(F.first("all").alias("all")).select("h", F.posexplode("all").alias("i", "m"))
    typ = kind(F.col("m"))
    found = written(found.withColumn("typ", typ).withColumn("c", canonical(F.col("m"), F.col("typ"))), "entities")
    mapping = surrogates(found.select("typ", "c").distinct(), key)
    filled = found.join(mapping, ["typ", "c"]).select("h", "i", poured().alias("by"))
    # Names that no column of the documents has.
    taken = {c.lower() for c in names}
    h, by, between = (w + "_" * (1 + max((len(c) for c in taken if c.startswith(w)), default=0)) for w in ("__h", "__by", "__between"))
    filled = filled.groupBy(F.col("h").alias(h)).agg(F.sort_array(F.collect_list(F.struct("i", "by"))).alias(by))
    touched = documents.where(has).withColumn(h, F.md5(body.cast("binary"))).join(filled, h)
    # Text between entities and surrogates, in turn.
    touched = touched.withColumn(between, F.split(body, found_by(body), -1))
    new = F.expr(f"array_join(transform({between}, (x, i) -> concat(x, coalesce(get({by}, i).by, ''))), '')")
    touched = touched.select(*[new.alias(c) if c == text else F.col(f"`{c}`") for c in names], F.size(by).cast("long").alias("n_replaced"))
    return touched.unionByName(documents.where(~has).withColumn("n_replaced", F.lit(0).cast("long")))
