"""Personal data replaced by surrogates.

Entities found in the texts are brought to a canonical form (digits of a number, lower-case address, given name with
gender and script, family name with script). Each distinct canonical form gets a keyed surrogate of its type; surrogates
that equal a real entity or an earlier surrogate are drawn anew, from a wider space each time (longer names and domains;
after PLAIN attempts further digits), so the drawing ends however many entities there are. Equal entities stay equal and
different ones different throughout the corpus; a family name gets the same surrogate with and without a given name. An
occurrence is filled in its own format. Every text meets the patterns once, and once more where it is cut. Main path:
DataFrame functions only.

A null text stays null, an empty one empty; texts without entities stay as they are; repeated rows get the same text; an
empty table gives an empty result; all columns of the input are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from disclosa.llm.common import digest, discard, let, materialise

#: Titles that show a gender, by gender.
TITLES = {
    "f": ("Mrs.", "Ms.", "Miss", "Frau", "Señora", "Sra.", "Madame", "Mme", "г-жа"),
    "m": ("Mr.", "Herr", "Señor", "Sr.", "Monsieur", "г-н"),
}
#: Given names by gender and script.
GIVEN = {
    "fl": ("Alma", "Berta", "Clara", "Dora", "Elena", "Flora", "Greta", "Hanna", "Irma", "Julia", "Karla", "Lena", "Marta", "Nora", "Olga", "Paula"),
    "ml": ("Anton", "Bruno", "Carlos", "David", "Emil", "Felix", "Gustav", "Hugo", "Ivo", "Jakob", "Karl", "Leo", "Martin", "Niels", "Otto", "Pablo"),
    "fc": ("Алла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина"),
    "mc": ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Игорь"),
}
#: Syllables of family names by script.
SYLLABLES = {
    "l": ("ba", "den", "kor", "lin", "mar", "nes", "pol", "ras", "sel", "tan", "vik", "wen", "zor", "hal", "gar", "fos"),
    "c": ("ба", "ден", "кор", "лин", "мар", "нес", "пол", "рас", "сел", "тан", "вик", "вен", "зор", "хал", "гар", "фос"),
}
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_TITLE = "(?:" + "|".join(t.replace(".", r"\.") for ts in TITLES.values() for t in ts) + ")"
_NAME = r"\p{Lu}\p{Ll}++(?:-\p{Lu}\p{Ll}++)?"
#: What is an entity. Every part starts at a place that one look back decides, so long runs stay cheap.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*(?<=\.[A-Za-z]{2,24})"
PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])|(?<![0-9(.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
CARD = r"(?<![0-9])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){3}(?![0-9])"
ADDRESS = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
PERSON = rf"(?<![\p{{L}}]){_TITLE} {_NAME}(?: {_NAME})?"
ENTITY = "|".join((EMAIL, CARD, SSN, PHONE, ADDRESS, IBAN, PERSON))
#: A cheap condition that every text with an entity meets.
GATE = rf"[0-9@]|{_TITLE} "

#: Attempts within the usual format of numbers and addresses.
PLAIN = 6
ENTITY_TYPE = "struct<kind:string,canon:string,held:string>"


def kind_of(m: Column) -> Column:
    first = F.substring_index(m, " ", 1)
    return (
        F.when(m.contains("@"), "email")
        .when(first.isin(*TITLES["f"], *TITLES["m"]), "name")
        .when(m.rlike("^[A-Z]"), "iban")
        .when(m.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "address")
        .when(F.length(F.regexp_replace(m, "[^0-9]", "")).between(16, 16) & ~m.startswith("+"), "card")
        .otherwise("phone")
    )


def canonical(m: Column, kind: Column) -> Column:
    title, rest = F.substring_index(m, " ", 1), F.expr("null")
    rest = F.regexp_replace(m, r"^\S+ ", "")
    gender = F.when(title.isin(*TITLES["f"]), "f").otherwise("m")
    script = F.when(rest.rlike(r"^\p{IsCyrillic}"), "c").otherwise("l")
    return (
        F.when(kind == "email", F.lower(m))
        .when(kind == "name", F.concat(gender, script, F.lit(":"), rest))
        .when(kind == "address", m)
        .when(kind == "iban", F.regexp_replace(m, " ", ""))
        .otherwise(F.regexp_replace(m, "[^0-9]", ""))
    )


def entities(text: Column) -> Column:
    """The entities of a text in order, as array<ENTITY_TYPE>."""
    found = F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))
    return F.transform(found, lambda m: let(kind_of(m), lambda k: F.struct(k.alias("kind"), canonical(m, k).alias("canon"), m.alias("held"))))


def _pick(h: Column, at: Column | int, choices: tuple[str, ...] | str) -> Column:
    """One of the choices by two hex digits of h (64 of them) from place `at` on."""
    value = F.conv(F.substr(h, F.lit(at) % 31 * 2 + 1 if isinstance(at, int) else at % 31 * 2 + 1, F.lit(2)), 16, 10).cast("int")
    return F.element_at(F.array(*map(F.lit, choices)), value % len(choices) + 1)


def _by_class(text: Column, h: Column) -> Column:
    """Letters for letters and digits for digits, other characters as they are."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    swap = lambda c, i: (
        F.when(c.rlike("[0-9]"), _pick(h, i, "0123456789"))
        .when(c.rlike("[A-Z]"), _pick(h, i, "ABCDEFGHJKLMNPRSTUVWXYZ"))
        .when(c.rlike("[a-z]"), _pick(h, i, "abcdefghijklmnoprstuvwxyz"))
        .otherwise(c)
    )
    return F.array_join(F.transform(chars, swap), "")


def _luhn(digits: Column) -> Column:
    """The sum of a card number's digits after doubling every second one from the right; valid if it ends in 0."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))
    part = lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0))
    return F.aggregate(F.transform(chars, part), F.lit(0), lambda a, x: a + x)


def parts_of(kind: Column, canon: Column) -> Column:
    """What of an entity gets surrogates of its own: a name's given and family part, else the entity."""
    of, name = F.substr(canon, F.lit(1), F.lit(2)), F.substr(canon, F.lit(4))
    pair = lambda k, c: F.struct(k.alias("kind"), c.alias("canon"))
    family = pair(F.lit("family"), F.concat(F.substr(of, F.lit(2), F.lit(1)), F.lit(":"), F.substring_index(name, " ", -1)))
    given = pair(F.lit("given"), F.concat(of, F.lit(":"), F.substring_index(name, " ", 1)))
    return F.when(kind == "name", F.when(name.contains(" "), F.array(given, family)).otherwise(F.array(family))).otherwise(F.array(pair(kind, canon)))


def surrogate(kind: Column, canon: Column, attempt: int, key: str) -> Column:
    """A canonical form of the same kind, drawn from the key, the canonical form and the attempt."""
    h0 = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, F.lit(str(attempt))).cast("binary"), 256)

    def drawn(h: Column) -> Column:
        digits = _by_class(F.regexp_replace(canon, "[^0-9]", ""), h)
        n = F.length(canon)
        more = [_pick(h, 18 + k, "0123456789") for k in range(min(12, attempt - PLAIN + 1))]
        local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, ".", -1)
        email = F.concat(_by_class(local, h), F.lit("@"), *(_pick(h, 20 + k, "bcdfghjklmnprstvz") for k in range(5 + attempt)), F.lit(".example."), F.when(domain.isin("com", "org", "net"), domain).otherwise("org"))
        area = F.concat(_pick(h, 0, "23456789"), F.substr(digits, F.lit(2), F.lit(2)))
        phone = F.when(n >= 10, F.concat(F.substr(canon, F.lit(1), n - 10), area, F.lit("555") if not attempt else F.substr(digits, n - 6, F.lit(3)), F.substr(digits, n - 3, F.lit(4)))).otherwise(digits)
        body = F.concat(F.substr(canon, F.lit(1), F.lit(1)), F.substr(digits, F.lit(2), n - 2))
        check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
        card = F.concat(body, F.when(_luhn(canon) % 10 == 0, check).otherwise(F.substr(digits, n, F.lit(1))))
        octet = lambda k: F.conv(F.substr(h, F.lit(2 * k + 1), F.lit(2)), 16, 10)
        address = F.concat_ws(".", octet(3) if attempt else F.lit("10"), octet(0), octet(1), octet(2))
        iban = F.concat(F.substr(canon, F.lit(1), F.lit(2)), _by_class(F.substr(canon, F.lit(3)), h))
        of = F.substring_index(canon, ":", 1)
        given = F.coalesce(*(F.when(of == k, F.concat_ws("-", *(_pick(h, 1 + 5 * i, v) for i in range(attempt + 1)))) for k, v in GIVEN.items()))
        family = F.initcap(F.coalesce(*(F.when(of == k, F.concat(*(_pick(h, 3 + i, v) for i in range(4 + attempt)))) for k, v in SYLLABLES.items())))
        ssn = F.concat(F.lit("9"), F.substr(digits, F.lit(2))) if attempt < PLAIN // 2 else digits
        long = lambda x: F.concat(x, *more) if more else x
        return (
            F.when(kind == "email", email).when(kind == "phone", long(phone)).when(kind == "card", long(card)).when(kind == "ssn", long(ssn)).when(kind == "address", long(address))
            .when(kind == "iban", long(iban)).when(kind == "given", F.concat(of, F.lit(":"), given)).otherwise(F.concat(of, F.lit(":"), family))
        )

    return let(h0, drawn)


def filled(held: Column, kind: Column, values: Column) -> Column:
    """An occurrence with its letters and digits, or its name or address, taken from the canonical forms of its parts' surrogates."""
    value = F.element_at(values, 1)
    chars = F.filter(F.split(held, ""), lambda c: c != "")
    place = lambda i: F.length(F.regexp_replace(F.substr(held, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
    shaped = F.array_join(F.transform(chars, lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substr(value, place(i), F.lit(1))).otherwise(c)), "")
    rest = F.substr(value, F.length(F.regexp_replace(held, "[^0-9A-Za-z]", "")) + 1)
    name = F.concat_ws(" ", F.substring_index(held, " ", 1), F.transform(values, lambda v: F.substring_index(v, ":", -1)))
    return F.when(kind.isin("email", "address"), value).when(kind == "name", name).otherwise(F.concat(shaped, rest))


def assign(distinct: DataFrame, key: str) -> DataFrame:
    """kind, canon, value: distinct surrogates that are no real entity, for every row of distinct(kind, canon)."""
    real = distinct.select("kind", F.col("canon").alias("value"))
    done, pending, attempt = None, distinct, 0
    while True:
        drawn = materialise(pending.withColumn("value", surrogate(F.col("kind"), F.col("canon"), attempt, key)), "drawn")
        free = drawn.join(real, ["kind", "value"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "value"), ["kind", "value"], "left_anti")
        good = materialise(free.groupBy("kind", "value").agg(F.min("canon").alias("canon")).select("kind", "canon", "value"), "assigned")
        done = good if done is None else done.unionByName(good)
        pending = drawn.select("kind", "canon").join(good.select("kind", "canon"), ["kind", "canon"], "left_anti")
        attempt += 1
        if not pending.limit(1).count():
            discard(drawn)
            return done


def replace(documents: DataFrame, key: str = "surrogates-1", kinds: str | None = "_pii_found") -> DataFrame:
    """documents with surrogates in text; the column named by `kinds` gets the kinds of the entities replaced, in order."""
    packed = documents.select(F.struct("*").alias("row"))
    text = F.col("row.text")
    none = F.array().cast(f"array<{ENTITY_TYPE}>")
    held = materialise(packed.select("row", F.when(text.rlike(GATE), entities(text)).otherwise(none).alias("e")), "entities")
    dirty = held.where(F.size("e") > 0).withColumn("blob", digest(text))
    found = dirty.groupBy("blob").agg(F.first("e").alias("e")).select("blob", F.posexplode("e").alias("at", "e"))
    parts = found.select("blob", "at", F.col("e.kind").alias("of"), "e.held", F.posexplode(parts_of(F.col("e.kind"), F.col("e.canon"))).alias("part", "p"))
    parts = materialise(parts.select("blob", "at", "of", "held", "part", "p.kind", "p.canon"), "parts")
    values = materialise(assign(materialise(parts.select("kind", "canon").distinct(), "distinct"), key), "values")
    value = F.transform(F.array_sort(F.collect_list(F.struct("part", "value"))), lambda v: v["value"])
    whole = parts.join(values, ["kind", "canon"]).groupBy("blob", "at").agg(F.first("of").alias("of"), F.first("held").alias("held"), value.alias("v"))
    put = F.struct("at", filled(F.col("held"), F.col("of"), F.col("v")).alias("put"))
    puts = materialise(whole.groupBy("blob").agg(F.array_sort(F.collect_list(put)).alias("puts")), "puts")
    pieces = F.zip_with(F.split(text, ENTITY, -1), F.transform("puts", lambda p: p["put"]), lambda gap, p: F.concat(gap, F.coalesce(p, F.lit(""))))
    done = dirty.join(puts, "blob").select("row", F.array_join(pieces, "").alias("text"), F.transform("e", lambda e: e["kind"]).alias("kinds"))
    both = held.where(F.size("e") == 0).select("row", text.alias("text"), F.array().cast("array<string>").alias("kinds")).unionByName(done)
    columns = [(F.col("text") if c == "text" else F.col(f"row.`{c}`")).alias(c) for c in documents.columns]
    return both.select(*columns, *([F.col("kinds").alias(kinds)] if kinds else []))
