"""Personal data replaced by keyed surrogates of the same kind and shape, in DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recogna.functions.skew import attach
from recogna.llm.common import ROW_KEY, clash_free, stored, with_row_key

# What is detected. Every pattern starts where no such character stands before it and has
# bounded or possessive repeats, so a long run of one character is read once.
_TITLES = {
    "male": "Mr|Mister|Herr|Monsieur|Señor|Sr|Don|г-н|господин|κύριος",
    "female": "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Srta|Doña|г-жа|госпожа|κυρία",
}
_WORD = r"\p{Lu}[\p{L}'-]{1,30}+"
KINDS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9])(?=[a-f]{0,63}[0-9])(?=[0-9]{0,63}[a-f])[0-9a-f]{32,64}(?![A-Za-z0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])|(?<![A-Za-z0-9])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "card": r"(?<![A-Za-z0-9])[0-9](?:[ -]?[0-9]){12,18}(?![A-Za-z0-9])",
    "ip": r"(?<![A-Za-z0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])(?![0-9]|\.[0-9])",
    "ssn": r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": rf"(?<![\p{{L}}0-9])(?:{'|'.join(_TITLES.values())})\.? {_WORD}(?: {_WORD})?",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())

#: A character is replaced by one of its own set, so script, case and word shape stay.
ALPHABETS = [
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "аеиоуыэюя", "бвгджзклмнпрстфхцчшщ", "АЕИОУЭЮЯ", "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
    "áàâäãåāąæéèêëēęěíìîïīóòôöõøōőœúùûüūůűýÿ", "çćčďđğłľñńňřśšşťțźżžßþ",
    "ÁÀÂÄÃÅĀĄÆÉÈÊËĒĘĚÍÌÎÏĪÓÒÔÖÕØŌŐŒÚÙÛÜŪŮŰÝ", "ÇĆČĎĐĞŁĽÑŃŇŘŚŠŞŤȚŹŻŽÞ",
    "ёіїєў", "ъь", "йґ", "ЁІЇЄЎ", "ЪЬ", "ЙҐ", "άέήίόύώϊϋΐΰ", "ΆΈΉΊΌΎΏΪΫ",
]
#: A letter of a widened surrogate is replaced by any of its script and case.
WIDE_ALPHABETS = [
    (r"\d", "0123456789"),
    (r"[\p{IsLatin}&&\p{Ll}]", "abcdefghijklmnopqrstuvwxyz"), (r"[\p{IsLatin}&&\p{Lu}]", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (r"[\p{IsCyrillic}&&\p{Ll}]", "абвгдежзиклмнопрстуфхцчшщыэюя"), (r"[\p{IsCyrillic}&&\p{Lu}]", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЫЭЮЯ"),
    (r"[\p{IsGreek}&&\p{Ll}]", "αβγδεζηθικλμνξοπρστυφχψω"), (r"[\p{IsGreek}&&\p{Lu}]", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
]
HEX = "0123456789abcdef"
#: Attempts within the entity's own alphabets, and those in which word endings move and letters move within their script;
#: later surrogates grow by a keyed character an attempt.
ATTEMPTS, WIDE_ATTEMPTS = 8, 4


def kind_of(mention: Column) -> Column:
    """The first kind whose pattern the whole mention fits."""
    tests = [(k, mention.rlike(f"^(?:{p})$")) for k, p in KINDS.items()]
    return F.coalesce(*[F.when(test, F.lit(k)) for k, test in tests])


def canonical(mention: Column, kind: Column) -> Column:
    """What makes two mentions the same entity: digits of numbers, lower case of addresses, otherwise the text."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(mention, "[^0-9]", ""))
        .when(kind == "iban", F.translate(mention, " ", ""))
        .when(kind == "email", F.lower(mention))
        .otherwise(mention)
    )


def _shifted(char: Column, by: Column, alphabet: str) -> Column:
    n = len(alphabet)
    return F.substring(F.lit(alphabet), (F.instr(F.lit(alphabet), char) - 1 + by) % n + 1, F.lit(1))


def _at(by: Column, alphabet: str) -> Column:
    return F.substring(F.lit(alphabet), by % len(alphabet) + 1, F.lit(1))


def _luhn(digits: Column) -> Column:
    """Digits with the last one set so that the number passes the card check."""
    body = F.split(F.reverse(F.substring(digits, F.lit(1), F.length(digits) - 1)), "")

    def value(d: Column, i: Column) -> Column:
        twice = d.cast("int") * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d.cast("int"))

    total = F.aggregate(F.transform(body, value), F.lit(0), lambda a, x: a + x)
    return F.concat(F.substring(digits, F.lit(1), F.length(digits) - 1), ((10 - total % 10) % 10).cast("string"))


def surrogate(kind: Column, entity: Column, attempt: int, key: str) -> Column:
    """The keyed surrogate of a canonical entity.

    The i-th character moves within its alphabet by the i-th byte of a SHA-512 stream over key, kind,
    entity and attempt. Kept as they are: titles and word endings of persons (they carry the gender), the
    country of an IBAN, the first digit of cards and phone numbers, the last label of an address's domain. Parts of
    an IP address are 1 to 254; cards pass the card check.

    After ``ATTEMPTS`` word endings of persons move too and letters become any of their script and case. After
    ``WIDE_ATTEMPTS`` more every surrogate has keyed characters besides, one more each attempt: letters after
    names and before addresses, hexadecimal digits for secrets, a further part for IP addresses, otherwise digits.
    """
    wide, longer = attempt >= ATTEMPTS, max(0, attempt - ATTEMPTS - WIDE_ATTEMPTS + 1)
    attempt = F.lit(attempt)
    stream = F.concat(*[F.sha2(F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"), F.lit(str(b))), 512) for b in range(2)])

    def byte(i: Column) -> Column:
        return F.conv(F.substring(stream, (i % 128) * 2 + 1, F.lit(2)), 16, 10).cast("int")

    def moved(char: Column, i: Column) -> Column:
        if wide:
            out = F.when(kind == "secret", _at(byte(i), HEX))
            for fits, alphabet in WIDE_ALPHABETS:
                out = out.when(char.rlike(fits), _at(byte(i), alphabet))
            return out.otherwise(char)
        out = reduce(lambda w, a: w.when(F.instr(F.lit(a), char) > 0, _shifted(char, byte(i), a)), ALPHABETS, F.when(kind == "secret", _shifted(char, byte(i), HEX)))
        return out.otherwise(char)

    title = F.length(F.regexp_extract(entity, r"^[^ ]+ ", 0))
    ends = F.split(entity, "")
    last = F.length(entity)
    fixed_from = F.when(kind == "email", last - F.length(F.substring_index(entity, ".", -1))).otherwise(last + 1)
    fixed_to = F.when(kind == "person", title).when(kind == "iban", 2).when(kind.isin("card", "phone"), 1).otherwise(0)

    def place(char: Column, i: Column) -> Column:
        word_end = (kind == "person") & F.coalesce(F.get(ends, i + 1) == " ", i + 1 == last)
        return F.when((i < fixed_to) | (i >= fixed_from) | (F.lit(not wide) & word_end), char).otherwise(moved(char, i))

    shaped = F.array_join(F.transform(ends, place), "")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3 + longer)), lambda i: (byte(i) % 254 + 1).cast("string")), ".")
    if longer:
        places = F.sequence(F.lit(1), F.lit(longer))

        def more(alphabet: str) -> Column:  # two bytes of the stream's hash for each character
            return F.array_join(F.transform(places, lambda i: _at(F.conv(F.substring(F.sha2(F.concat_ws("\x1f", stream, i.cast("string")), 512), F.lit(1), F.lit(4)), 16, 10).cast("int"), alphabet)), "")

        latin, cyrillic, greek = WIDE_ALPHABETS[1][1], WIDE_ALPHABETS[3][1], WIDE_ALPHABETS[5][1]
        letters = F.when(entity.rlike(r"\p{IsCyrillic}$"), more(cyrillic)).when(entity.rlike(r"\p{IsGreek}$"), more(greek)).otherwise(more(latin))
        shaped = (
            F.when(kind == "person", F.concat(shaped, letters))
            .when(kind == "email", F.concat(more(latin), shaped))
            .otherwise(F.concat(shaped, F.when(kind == "secret", more(HEX)).otherwise(more(WIDE_ALPHABETS[0][1]))))
        )
    return F.when(kind == "ip", octets).when(kind == "card", _luhn(shaped)).otherwise(shaped)


def rendered(mention: Column, kind: Column, replacement: Column) -> Column:
    """The surrogate in the mention's own format: its separators, its blanks, its upper case."""
    chars = F.split(mention, "")

    def laid(kept: str) -> Column:
        # how many characters of the entity stand before each character of the mention
        counted = F.aggregate(
            chars,
            F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
            lambda s, c: F.when(c.rlike(kept), F.struct(F.concat(s["out"], F.substring(replacement, s["at"] + 1, F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
                F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))
            ),
        )
        # a widened surrogate has characters beyond the mention's
        return F.concat(counted["out"], F.substring(replacement, counted["at"] + 1, F.length(replacement)))

    return (
        F.when(kind.isin("phone", "card", "ssn"), laid("[0-9]"))
        .when(kind == "iban", laid("[^ ]"))
        .when((kind == "email") & (mention == F.upper(mention)), F.upper(replacement))
        .otherwise(replacement)
    )


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, entity, surrogate): one surrogate for each entity of the corpus, no two alike, none of them an entity.

    Each round proposes a surrogate for the entities still open. A proposal stands if it is nobody's real
    data and not taken, and goes to the smallest of those that proposed it; the others try their next one. Where
    an entity's own shape has no free surrogate, later attempts widen it and then make it longer, so all get one.
    """
    entities = stored(entities, "pii-entities")
    real = entities.select("kind", F.col("entity").alias("surrogate"))
    done, pending = None, entities
    for attempt in count():
        offers = pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), attempt, key))
        free = offers.join(real, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = free.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity")).select("kind", "entity", "surrogate")
        done = stored(won if done is None else done.unionByName(won), "pii-surrogates")
        pending = entities.join(done, ["kind", "entity"], "left_anti")
        if pending.isEmpty():
            return done


@clash_free()
def replace_pii(docs: DataFrame, key: str) -> DataFrame:
    """All columns of ``docs``, the text with surrogates, and ``n_replaced``.

    Mentions of one entity get the same surrogate in all documents, each in its own format. Distinct entities
    are aggregated before surrogates are made, and a frequent entity's mentions meet its one row in a join that can
    be split. Only mentions are shuffled by entity; a document's surrogates then join its row. A text is
    cut at its mentions and put together again, so nothing else in it changes.

    Null text stays null with 0 replaced; repeated rows are replaced alike. A column of ``docs`` named
    ``n_replaced`` is replaced; all others come back whatever they are called. The same key gives the same surrogates for the same corpus.
    """
    rows = with_row_key(docs.drop("n_replaced"))
    found = rows.select(*ROW_KEY, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)).alias("found")).where(F.size("found") > 0)
    found = found.dropDuplicates(ROW_KEY)
    mentions = found.select(*ROW_KEY, F.posexplode("found").alias("place", "mention")).withColumn("kind", kind_of(F.col("mention")))
    mentions = stored(mentions.withColumn("entity", canonical(F.col("mention"), F.col("kind"))), "pii-mentions")
    surrogates = assign(mentions.groupBy("kind", "entity").agg(F.lit(1).alias("one")).drop("one"), key)
    written = attach(mentions, surrogates, ["kind", "entity"])
    written = written.withColumn("put", rendered(F.col("mention"), F.col("kind"), F.col("surrogate")))
    puts = written.groupBy(*ROW_KEY).agg(F.sort_array(F.collect_list(F.struct("place", "put"))).alias("_puts"))
    joined = rows.join(puts, ROW_KEY, "left")
    between = F.split("text", PATTERN, -1)
    text = F.array_join(F.transform(between, lambda t, i: F.concat(t, F.coalesce(F.get("_puts", i)["put"], F.lit("")))), "")
    return joined.select(
        *[F.when(F.col("_puts").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(c) for c in rows.columns if c not in ROW_KEY],
        F.when(F.col("_puts").isNull(), 0).otherwise(F.size("_puts")).cast("long").alias("n_replaced"),
    )
