"""PII surrogates: every detected entity gets a keyed replacement of its own type, format, script and gender.

Spark functions only. One pattern finds e-mail and IP addresses (both versions), phone, card, bank account and social
security numbers, and persons after one title or several. Card numbers have 13 to 19 digits and a valid
check digit. An entity's canonical form (lower case, bare digits; with the title's gender for persons) is what
coreference means: it has one surrogate in the whole corpus, written in each mention's own format. Letters
and digits of a surrogate come from a keyed hash of type, canonical form and attempt; persons get names
of the title's gender in the name's script.

Within a text a name that a title made known is replaced wherever it stands, also without title, and so is
each of its words, by the same word of its surrogate. A titled last name alone is the first person of
that name and of no other gender in the text; a title without gender takes that of the same name's other titles there.

Distinctness: the distinct entities of the corpus are collected into one table with their first surrogate;
as long as two entities of a type share one, or one equals an entity that is in the corpus, all but the
least of them try again with the next attempt number.

Texts are scanned once and written cut up at their entities; what follows works on mentions. Entities and copies of
texts that a large share of the corpus has are spread over tasks.

Null text stays null, with 0 entities. Very long texts are scanned whole. Ties: of equal surrogates the least entity
keeps its own. Empty texts and texts without entities stay as they are. Repeated rows: each is
returned, with the same replacements. Empty tables: empty result. Other columns of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import by_frequency, salted, written

#: Titles by gender, and given and family names by gender and script.
MALE_TITLES, FEMALE_TITLES, PLAIN_TITLES = "Mr|MR|Herr|HERR|Monsieur|Señor|Sr|Г-н|Господин|Κύριος|Κος", "Mrs|MRS|Ms|MS|Miss|MISS|Frau|FRAU|Madame|Mme|Mlle|Señora|Sra|Srta|Г-жа|Госпожа|Κυρία|Κα", "Dr|DR|Prof|PROF"
NAMES = {
    ("latin", "m"): "Adam Albert Anton Arthur Bruno Carl Daniel David Edgar Emil Erik Felix Frank Georg Hugo Ivan Jakob Karl Leo Louis Marco Martin Max Nils Oscar Otto Paul Peter Ralph Simon Theo Victor",
    ("latin", "f"): "Ada Agnes Alma Anna Carla Clara Diana Edith Elena Emma Eva Flora Gina Greta Hanna Helga Ida Irene Jana Julia Klara Laura Lena Lucia Maria Martha Nora Olga Paula Rosa Sofia Vera",
    ("latin", "n"): "Alex Andrea Ariel Bo Charlie Chris Dana Eden Fran Gale Jamie Jan Jean Jo Jordan Kim Kris Lee Leslie Lou Max Merle Morgan Nicky Noel Pat Robin Sam Sascha Sky Toni Val",
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Захар Иван Кирилл Лев Максим Никита Олег Павел Роман Степан",
    ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лидия Мария Нина Ольга Полина Раиса София",
    ("cyrillic", "n"): "Женя Саша Валя Слава",
    ("greek", "m"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Λεωνίδας Μιχάλης Νίκος Πέτρος Σπύρος Στέλιος",
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία Φωτεινή Χριστίνα",
    ("greek", "n"): "Μαρίνος Φανή Χρύσα Αριστέα",
}
#: Parts that family names are made of, three to a name.
FAMILY = {
    "latin": "al an ar ba bel ber bo bran cor da del den dor el en er fal fer gar gel han har hol in jan kal kel lan lar len lo lun mar mel mon nel nor ol or pal ran rel ros sal san sel sol tal tan ter tor val van ver vin wal wel win zan",
    "greek": "αλ αν βασ βελ γερ γιαν δαμ δημ ελ ζαχ θεο καλ καρ κων λαμ λεο μαν μαρ μιχ νικ παπ παυ πετ ραλ σαβ σταυ στε τσα φιλ χατ χρισ",
    "cyrillic": "ал ан ар бел бер бор вал вер вол гал гор дан дор ел ер жар зар зол ив кал кар ков лан лар лев мар мел мор нар нов ол ор пал пол рад ров сал сев сол тал тар тор фал хар чер шар юр ян",
}
_TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}|{PLAIN_TITLES}"
#: Words of a name end in a letter, before a genitive 's.
_WORD = r"\p{Lu}(?:(?![’']s(?!\p{L}))[’'-]?\p{L})+"
_NAME = rf"(?!(?:{_TITLES})(?!\p{{L}})){_WORD}(?:\x20{_WORD}){{0,2}}"
_TITLE = rf"(?:(?:{_TITLES})\.?\x20)+"
_HEX = "[0-9A-Fa-f]{1,4}"
#: Eight groups, or fewer around a double colon; a digit is in it, so that a::b is none.
_IP6 = rf"(?<![0-9A-Za-z:.])(?=[A-Fa-f:]*[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?|::{_HEX}(?::{_HEX}){{0,6}})(?![0-9A-Za-z]|:[0-9A-Fa-f])"
#: The patterns by type, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": rf"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){{3}}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])|{_IP6}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9+-])[0-9]{4}(?:(?:[\x20-]?[0-9]{4}){2}[\x20-]?[0-9]{1,7}|[\x20-][0-9]{6}[\x20-][0-9]{4,5})(?![0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{1,4}\)[\x20.-]?)?[0-9]{2,4}(?:[\x20.-]?[0-9]{2,4}){1,4}|\([0-9]{3}\)\x20?[0-9]{3}[.-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9])",
    "person": rf"(?<![\p{{L}}]){_TITLE}{_NAME}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Cheap tests of what any entity needs: a digit or an at sign, or a title.
_MAYBE = rf"[0-9@]|(?:^|[^\p{{L}}])(?:{_TITLES})\.?\x20\p{{Lu}}"
ATTEMPTS = 40


def _type_of(entity: Column) -> Column:
    test = lambda p: entity.rlike(rf"^(?:{p})$")
    # look-arounds hold at both ends of the entity alone
    card = F.when(luhn_total(F.regexp_replace(entity, "[^0-9]", "")) % 10 == 0, "card").otherwise("none")
    return F.coalesce(*[F.when(test(PATTERNS[k]), card if k == "card" else F.lit(k)) for k in ("email", "ip", "iban", "ssn", "card", "phone")], F.lit("person"))


def _canonical(entity: Column, kind: Column) -> Column:
    name = F.lower(F.regexp_replace(entity, f"^{_TITLE}", ""))
    return F.when(kind.isin("email", "ip"), F.lower(entity)).when(kind == "iban", F.regexp_replace(entity, " ", "")).when(kind == "person", name).otherwise(F.regexp_replace(entity, "[^0-9]", ""))


def _gender(entity: Column) -> Column:
    first = lambda titles: entity.rlike(rf"^(?:(?:{PLAIN_TITLES})\.?\x20)*(?:{titles})\.?\x20")
    return F.when(first(MALE_TITLES), "m").when(first(FEMALE_TITLES), "f").otherwise("n")


def _pattern(persons: Column) -> Column:
    """ANY, and the bare names of these titled persons and their words, as they are or in other capitals; whole names first."""
    bare = F.array_distinct(F.transform(persons, lambda x: F.regexp_replace(x, f"^{_TITLE}", "")))
    spelled = lambda a: F.flatten(F.transform(a, lambda x: F.array(x, F.upper(x), F.initcap(F.lower(x)))))
    words = F.filter(F.flatten(F.transform(bare, lambda x: F.split(x, " "))), lambda w: F.length(w) > 1)
    forms = F.array_distinct(F.concat(spelled(F.filter(bare, lambda x: x.contains(" "))), spelled(words)))
    # longer ones first, so that no name hides one that goes on
    forms = F.transform(F.reverse(F.array_sort(F.transform(forms, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))), lambda x: x.x)
    return F.concat(F.lit(ANY + r"|(?<![\p{L}\p{N}])(?=\p{Lu})(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}\p{N}]|[A-Za-z0-9._%+-]{0,64}@)"))


def _resolved(each: DataFrame) -> DataFrame:
    """Mentions (key, pos, entity, kind, canonical, titled, gender) with the canonical form and gender of the person that they mean in their text, and part: which word of the name, 0 for all."""
    people = each.filter("titled").groupBy("key", "canonical", "gender").agg(F.min("pos").alias("at"))
    known = people.filter("gender <> 'n'").groupBy("key", "canonical").agg(F.min_by("gender", "at").alias("known"))
    sexed = lambda df: df.join(known, ["key", "canonical"], "left").withColumn("gender", F.when(F.col("gender") == "n", F.coalesce("known", F.lit("n"))).otherwise(F.col("gender"))).drop("known")
    words = F.split("canonical", " ")
    people = sexed(people).withColumn("whole", F.size(words) > 1)
    parts = people.select("key", "canonical", "gender", "at", "whole", F.size(words).alias("n"), F.posexplode(words).alias("i", "form"))
    # whole names are told by all their words, single words by persons with more of them, last names before others
    order = [(~F.col("whole")).alias("a"), (F.col("n") != F.col("i") + 1).alias("b"), "at", "gender", "canonical"]
    loose = parts.select("key", "form", F.struct(*order, F.when(F.col("whole"), F.col("i") + 1).otherwise(0).alias("part")).alias("who"))
    loose = loose.unionByName(people.filter("whole").select("key", F.col("canonical").alias("form"), F.struct((~F.col("whole")).alias("a"), F.lit(False).alias("b"), "at", "gender", "canonical", F.lit(0).alias("part")).alias("who")))
    loose = loose.groupBy("key", "form").agg(F.min("who").alias("who"))
    last = parts.filter("whole AND i + 1 = n").select("key", "form", "gender", F.struct("at", "gender", "canonical", F.col("n").alias("part")).alias("who"))
    last = last.groupBy("key", "form").agg(*[F.min(F.when(F.lit(g == "n") | F.col("gender").isin(g, "n"), F.col("who"))).alias(g) for g in "mfn"])
    alone = sexed(each.filter("titled")).join(last.withColumnRenamed("form", "canonical"), ["key", "canonical"], "left")
    alone = alone.withColumn("who", F.when(F.col("gender") == "m", F.col("m")).when(F.col("gender") == "f", F.col("f")).otherwise(F.col("n"))).drop("m", "f", "n")
    bare = each.filter("NOT titled AND kind = 'person'").join(loose.select("key", F.col("form").alias("canonical"), F.struct("who.at", "who.gender", "who.canonical", "who.part").alias("who")), ["key", "canonical"], "left")
    persons = alone.unionByName(bare)
    meant = lambda col: F.coalesce(F.col(f"who.{col}"), F.col(col)).alias(col)
    persons = persons.select("key", "pos", "entity", "kind", meant("canonical"), meant("gender"), F.coalesce("who.part", F.lit(0)).alias("part"))
    return persons.unionByName(each.filter("kind <> 'person'").select("key", "pos", "entity", "kind", "canonical", "gender", F.lit(0).alias("part")))


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


class _Drawn:
    """Numbers drawn from a keyed hash of an entity: `number(i, n)` is 0 to n - 1, by place i."""

    def __init__(self, key: str, kind: Column, canonical: Column, gender: Column, attempt: Column):
        canonical = F.when(kind == "person", F.concat_ws("\x1f", canonical, gender)).otherwise(canonical)
        self.digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, canonical, attempt.cast("string"), F.lit(key)).cast("binary"), 512)

    def number(self, digest: Column, i: Column | int, n: int) -> Column:
        at = F.pmod((F.lit(i) if isinstance(i, int) else i) * 5, F.lit(120)) + 1
        return F.pmod(F.conv(F.substring(digest, at, F.lit(8)), 16, 10).cast("long"), F.lit(n))


def _pick(words: str, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words.split()]), (number + 1).cast("int"))


def surrogate(key: str, kind: Column, canonical: Column, gender: Column, attempt: Column) -> Column:
    """The canonical surrogate of a canonical entity: letters for letters, digits for digits."""
    drawn = _Drawn(key, kind, canonical, gender, attempt)

    def body(d: Column) -> Column:
        draw = drawn.number
        letter = lambda c, i: F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (draw(d, i, 26) + 1).cast("int"), F.lit(1))
        digit = lambda i: draw(d, i, 10).cast("string")
        mapped = lambda text: F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(c.rlike("^[0-9]$"), digit(i)).when(c.rlike("^[A-Z]$"), F.upper(letter(c, i))).when(c.rlike("^[a-z]$"), letter(c, i)).otherwise(c)), "")
        email = F.concat(mapped(F.substring_index(canonical, "@", 1)), F.lit("@mail"), draw(d, 21, 1_000_000).cast("string"), F.lit(".example.org"))
        # 240.0.0.0 and up is reserved and routed nowhere
        ip4 = F.concat_ws(".", (draw(d, 1, 15) + 240).cast("string"), *[draw(d, i, 256).cast("string") for i in (2, 3, 4)])
        # 2001:db8 is kept for documentation; short forms stay short
        group = lambda i: F.lower(F.hex(draw(d, i, 65_535) + 1))
        ip6 = F.when(canonical.contains("::"), F.concat(F.lit("2001:db8::"), F.concat_ws(":", *map(group, (5, 6, 7))))).otherwise(F.concat_ws(":", F.lit("2001"), F.lit("db8"), *map(group, range(5, 11))))
        ip = F.when(canonical.contains(":"), ip6).otherwise(ip4)
        free = F.concat(F.substring(canonical, 1, 1), F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(canonical) - 2)), lambda i: digit(i)), ""))
        card = F.concat(free, F.when(luhn_total(canonical) % 10 == 0, F.pmod(F.lit(10) - luhn_total(F.concat(free, F.lit("0"))) % 10, F.lit(10)).cast("string")).otherwise(digit(19)))
        phone = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.when(F.length(canonical) - i > 10, c).otherwise(digit(i))), "")
        land, account = F.substring(canonical, 1, 2), mapped(F.substring(canonical, 5, 40))
        iban = F.concat(land, F.lpad((98 - remainder97(F.concat(account, land, F.lit("00")))).cast("string"), 2, "0"), account)
        first = F.coalesce(*[F.when((_script(canonical) == s) & (gender == g), _pick(names, draw(d, 3, len(names.split())))) for (s, g), names in NAMES.items()])
        family = lambda i: F.coalesce(*[F.when(_script(canonical) == s, F.concat(*[_pick(parts, draw(d, i + j, len(parts.split()))) for j in range(3)])) for s, parts in FAMILY.items()])
        last, second = family(8), family(12)
        # as many words as the name has; after the tenth attempt a double name, of which there are more
        words = F.size(F.split(canonical, " "))
        double = F.when(attempt > 10, F.concat(last, F.lit("-"), second)).otherwise(last)
        person = F.lower(F.when(words == 1, double).when(words == 2, F.concat_ws(" ", first, double)).otherwise(F.concat_ws(" ", first, second, double)))
        return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind == "phone", phone).when(kind == "iban", iban).when(kind == "person", person).otherwise(mapped(canonical))

    return F.get(F.transform(F.array(drawn.digest), body), F.lit(0))


def luhn_total(digits: Column) -> Column:
    """The check sum of a card number: a multiple of 10 if it is valid."""
    places = F.split(F.reverse(digits), "")
    value = lambda c, i: F.when(i % 2 == 0, c.cast("int")).when(c.cast("int") > 4, 2 * c.cast("int") - 9).otherwise(2 * c.cast("int"))
    return F.aggregate(F.transform(F.filter(places, lambda c: c != ""), value), F.lit(0), lambda a, x: a + x)


def remainder97(text: Column) -> Column:
    """An account number by the rule for its check digits: letters as 10 to 35, the rest of a division by 97."""
    value = lambda c: F.when(c.rlike("^[0-9]$"), c.cast("int")).otherwise(F.ascii(F.upper(c)) - 55)
    step = lambda a, x: (a * F.when(x > 9, 100).otherwise(10) + x) % 97
    return F.aggregate(F.transform(F.filter(F.split(text, ""), lambda c: c != ""), value), F.lit(0), step)


def _written_as(entity: Column, kind: Column, made: Column) -> Column:
    """A canonical surrogate in the format of a mention: its separators, its capitals, its title."""
    slots = F.split(entity, "")
    # separators stay in place: the n-th digit (or letter of an account) takes the n-th of the surrogate
    sign = lambda c: c.rlike("^[0-9]$") | ((kind == "iban") & c.rlike("^[A-Z]$"))
    step = lambda a, c: F.struct(F.concat(a.out, F.when(sign(c), F.substring(made, a.at, F.lit(1))).otherwise(c)).alias("out"), F.when(sign(c), a.at + 1).otherwise(a.at).alias("at"))
    numbers = F.aggregate(slots, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), step, lambda a: a.out)
    title = F.regexp_extract(entity, f"^{_TITLE}", 0)
    bare = F.regexp_replace(entity, f"^{_TITLE}", "")
    capitals = F.regexp_replace(F.initcap(F.regexp_replace(made, "-", " - ")), " - ", "-")
    name = F.concat(title, F.when(bare == F.upper(bare), F.upper(made)).otherwise(capitals))
    local = lambda text: F.split(F.substring_index(text, "@", 1), "")
    cased = F.array_join(F.zip_with(local(entity), local(made), lambda a, b: F.when(a.rlike("^[A-Z]$"), F.upper(b)).otherwise(b)), "")
    email = F.when(entity == F.upper(entity), F.upper(made)).otherwise(F.concat(cased, F.lit("@"), F.substring_index(made, "@", -1)))
    ip = F.when(entity.rlike("[A-F]") & (entity == F.upper(entity)), F.upper(made)).otherwise(made)
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "person", name).otherwise(numbers)


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canonical, gender, n, made): one surrogate for each distinct (kind, canonical, gender), no two of a kind alike and none equal to an entity of the corpus; n: its mentions.

    A person of two names or more whose titles tell no gender is the one of that name whose titles do, if the
    corpus has exactly one such: both have one surrogate.
    """
    counted = written(entities.groupBy("kind", "canonical", "gender").agg(F.count("*").alias("n")), "counted")
    known = counted.filter((F.col("kind") == "person") & F.col("canonical").contains(" ") & (F.col("gender") != "n"))
    one = known.groupBy("kind", "canonical").agg(F.min("gender").alias("of"), F.max("gender").alias("other")).filter("of = other").drop("other")
    same = written(counted.filter("gender = 'n'").join(one, ["kind", "canonical"]), "same-persons")
    table = _made(counted.join(same.select("kind", "canonical", "gender"), ["kind", "canonical", "gender"], "left_anti"), key).select("kind", "canonical", "gender", "n", "made")
    twins = same.join(table.select("kind", "canonical", F.col("gender").alias("of"), "made"), ["kind", "canonical", "of"])
    return table.unionByName(twins.select("kind", "canonical", "gender", "n", "made"))


def _made(counted: DataFrame, key: str) -> DataFrame:
    """Distinct entities with `made`, drawn anew where it clashes."""
    table = written(counted.withColumn("attempt", F.lit(0)), "entities")
    originals = table.select("kind", F.col("canonical").alias("made"), F.lit(True).alias("taken")).distinct()
    made = surrogate(key, F.col("kind"), F.col("canonical"), F.col("gender"), F.col("attempt"))
    table = written(table.withColumn("made", made), "surrogates")
    for _ in range(ATTEMPTS):
        crowd = table.groupBy("kind", "made").agg(F.count("*").alias("many"), F.min(F.struct("canonical", "gender")).alias("first"))
        # who has to try again: all but one of a crowd, and those that hit an entity of the corpus
        clash = crowd.join(originals, ["kind", "made"], "left").filter("many > 1 OR taken").select("kind", "made", "first", F.coalesce("taken", F.lit(False)).alias("taken"))
        clash = written(clash, "clashes")
        if clash.isEmpty():
            return table
        hit = table.join(clash, ["kind", "made"], "left")
        again = F.col("taken") | (F.col("first") != F.struct("canonical", "gender"))
        table = hit.withColumn("attempt", F.col("attempt") + F.coalesce(again, F.lit(False)).cast("int")).select("kind", "canonical", "gender", "n", "attempt")
        table = written(table.withColumn("made", made), "surrogates")
    raise RuntimeError("surrogates still clash: the space of a type is too small for its entities")


def _cut_up(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, key, pieces, gaps) of every row, written: texts with entities as their entities and what lies around these, other texts whole."""
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"), F.when(text.rlike(_MAYBE), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("found"))
    persons = F.filter("found", lambda x: x.rlike(f"^{_TITLE}"))
    # the name of a person is looked for without title too, so their texts are cut at a pattern of their own
    named = F.size(persons) > 0
    own = F.when(named, _pattern(persons))
    some = F.size("found") > 0
    pieces = F.when(named, F.regexp_extract_all("text", own, F.lit(0))).when(some, F.col("found"))
    gaps = F.when(named, F.split("text", own, -1)).when(some, F.split("text", F.lit(ANY), -1))
    return written(rows.select("id", F.when(some, F.lit(None)).otherwise(F.col("text")).alias("text"), F.when(some, F.sha2(F.col("text").cast("binary"), 256)).alias("key"), pieces.alias("pieces"), gaps.alias("gaps")), "texts")


def replace(df: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text with surrogates, n_entities, kinds) for every row; kinds counts the entities by type, as a map."""
    rows = _cut_up(df, id_col, text_col)
    own = rows.filter("key IS NOT NULL").drop("text")
    # replacements hang on the text alone, so copies of a text share them by its hash
    each = own.groupBy("key").agg(F.first("pieces").alias("pieces")).select("key", F.posexplode("pieces").alias("pos", "entity"))
    each = each.withColumn("kind", _type_of(F.col("entity")))
    person = F.col("kind") == "person"
    each = each.withColumns({"canonical": _canonical(F.col("entity"), F.col("kind")), "titled": person & F.col("entity").rlike(f"^{_TITLE}"), "gender": F.when(person, _gender(F.col("entity"))).otherwise("n")})
    each = written(_resolved(written(each, "mentions")).withColumn("who", F.concat_ws("\x1f", "kind", "gender", "canonical")), "resolved")
    made = written(mapping(each.filter("kind <> 'none'"), key).select(F.concat_ws("\x1f", "kind", "gender", "canonical").alias("who"), "made", "n"), "made")
    part = F.when(F.col("part") > 0, F.get(F.split("made", " "), F.col("part") - 1)).otherwise(F.col("made"))
    new = by_frequency(each.filter("kind <> 'none'"), made, "who").select("key", "pos", "kind", _written_as(F.col("entity"), F.col("kind"), part).alias("new"))
    placed = new.unionByName(each.filter("kind = 'none'").select("key", "pos", "kind", F.col("entity").alias("new")))
    lists = placed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("pos", "new", "kind"))).alias("new"))
    joined = salted(own.select("id", "key", "gaps"), written(lists, "replacements"), "key")
    pieces = F.zip_with(F.col("gaps"), F.transform("new", lambda x: x.new), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    counted = F.map_from_entries(F.transform(F.array(*map(F.lit, PATTERNS)), lambda k: F.struct(k, F.size(F.filter("new", lambda x: x.kind == k)))))
    done = joined.select("id", F.array_join(pieces, "").alias("text"), F.size(F.filter("new", lambda x: x.kind != "none")).cast("long").alias("n_entities"), counted.alias("kinds"))
    plain = rows.filter("key IS NULL").select("id", "text", F.lit(0).cast("long").alias("n_entities"), F.map_from_entries(F.array(*[F.struct(F.lit(k), F.lit(0)) for k in PATTERNS])).alias("kinds"))
    return done.unionByName(plain).withColumnsRenamed({"id": id_col})
