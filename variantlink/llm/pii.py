"""Surrogates for personal data (operator 7)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged, text_of

L, R = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
#: Titles that open a person's name, by the gender they tell.
FEMALE, MALE, EITHER = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Doña|госпожа", "Mr|Mister|Herr|Monsieur|M\\.|Señor|Sr|господин", "Dr|Prof|Professor|доктор"
TITLE = rf"(?:{FEMALE}|{MALE}|{EITHER})\.? "
#: What else tells a whole name: words before it, letters after it, a mail address in brackets.
LABEL = r"(?i:(?:full|patient|employee|applicant)(?:'s)? name ?: ?|(?:patient|applicant) ?: ?|my name is |signed by )"
AFTER = r"(?:,? (?:Ph\.?D|M\.?D|D\.?D\.?S|Esq|Jr|Sr)(?!\p{L})\.?| <(?=[^\s<>@]{1,64}@|\z))"
#: A word of a name, hyphens and apostrophes inside included, a possessive s not; an initial before it.
WORD = r"\p{Lu}(?=\p{L}|['’-]\p{Lu}|['’]\p{L}{2})[\p{L}\p{M}]*+(?:(?:['’-](?=\p{Lu})(?!S(?!\p{L}))|['’](?=\p{L}{2}))[\p{L}\p{M}]++)*+"
INITIALS = r"(?:\p{Lu}\. ){0,2}"
TITLED = rf"(?:{TITLE}){{1,3}}{INITIALS}{WORD}(?: {INITIALS}{WORD}){{0,2}}"
WHOLE = rf"{WORD}(?: {INITIALS}{WORD}){{1,3}}"
#: Names that are words too. Alone and without a title they are no mention of a person.
ORDINARY = (
    "January February March April May June July August September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday "
    "Will Can Must Might Shall Should Would Could Do Did Has Had Is Are Was Were Be The This That These Those He She It We They You In On At By For From "
    "To With And Or But If When Then There Here What Who Why How No Not Yes So As Of An All Any Some One Two Art Bill Bishop Black Brook Brown Carter Case "
    "Chance Chase Christian Church Cook Cross Day Dean Drew Earl English Faith Field Fish Forest Fox Frank Franklin Gay Grace Grant Gray Green Hall Hardy "
    "Heath Hill Home Hope House Hunter Ivy Jack Jewel Joy Justice King Lake Lane Law Lily Little Long Love Major Mark Marsh Mason Miles Mill Miller Moody "
    "Moon North Olive Page Park Parker Patience Peace Penny Pope Potter Price Prince Ray Rich Rob Rock Rose Ruby Rush Sky Small Smart South Stone Street "
    "Strong Sue Summer Taylor Temple Trinity Turner Violet Wall Ward Way Weaver West White Wise Wood Woods Young"
).split()
ASSIGNED = r"(?i:token|secret|password|passwd|pwd|api[_-]?key)\s{0,2}[=:]\s{0,2}[\"']?"
HEX = "[0-9A-Fa-f]{1,4}"
#: Kinds in order of precedence. A card number must also have its check digit (has_luhn).
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+'-])[\p{L}\p{N}][\p{L}\p{N}._%+'-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]+)+",
    "secret": rf"{L}(?:{ASSIGNED}[^\s\"']{{6,}}+|AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{20,}}+|sk-[A-Za-z0-9_-]{{20,}}+"
    r"|xox[abprs]-[A-Za-z0-9-]{10,}+|eyJ[A-Za-z0-9_-]{8,}+(?:\.[A-Za-z0-9_-]++){1,2}|[0-9a-f]{32,}+|[0-9A-F]{32,}+)" + R,
    "person": rf"{L}(?:{TITLED}|{LABEL}{INITIALS}{WHOLE}|{WHOLE}{AFTER})",
    # IPv4; IPv6 in full; IPv6 with a gap, whose first group has three digits at least (unlike a[1::2])
    "ip": rf"{L}(?:\d{{1,3}}(?:\.\d{{1,3}}){{3}}|(?:{HEX}:){{7}}{HEX}|[0-9A-Fa-f]{{3,4}}(?::{HEX}){{0,5}}::(?:{HEX}(?::{HEX}){{0,5}}){R}){R}",
    "iban": rf"{L}[A-Z]{{2}}\d{{2}}(?: ?[0-9A-Z]{{4}}){{3,7}}(?: ?[0-9A-Z]{{1,3}})?{R}",
    "ssn": rf"{L}\d{{3}}-\d{{2}}-\d{{4}}{R}",
    "card": rf"{L}[2-6](?:[ -]?\d){{12,18}}{R}",
    "phone": rf"(?<![\p{{L}}\p{{N}}+])(?:(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{1,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]\d{{3,4}}|\+\d{{8,15}}"
    # a country code and groups of two to eight digits; ten digits in pairs; an area code and one more group
    rf"|\+\d{{1,3}}[ .-]\(?\d{{1,4}}\)?(?:[ .-]\d{{2,8}}){{1,5}}|0\d(?:[ .-]\d{{2}}){{4}}|0\d{{2,4}}[ /-]\d{{6,8}}){R}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every entity holds one of these; texts without them are passed over.
HINT = rf"[0-9@=:]|eyJ|[A-Za-z0-9_-]{{15}}|{TITLE}\p{{Lu}}|{LABEL}|\p{{L}}{AFTER}"
PERSON = ("family", "given:f", "given:m", "given")

LOWER, UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
CYRILLIC, ACCENTED = "абвгдежзиклмнопрстуфхцчшэюя", "áâàéêèíîóôúûñçäöü"
ONSETS, VOWELS, CODAS = "b d f g k l m n p r s t v z".split(), "a e i o u".split(), ["", "n", "r", "l", "s"]
CYRILLIC_ONSETS, CYRILLIC_VOWELS, CYRILLIC_CODAS = "б в г д з к л м н п р с т ф".split(), "а е и о у".split(), ["", "н", "р", "л", "с"]
#: Letters that get an accent, and those that stand for them by the accents a name has (acute where it has another).
PLAIN_VOWELS, ACCENTS = "aeiou", {"[äëïöüÄËÏÖÜ]": "äöüöü", "[àèìòùÀÈÌÒÙ]": "àèìòù", "[âêîôûÂÊÎÔÛ]": "âêîôû", r"[^\x00-\x7F'’-]": "áéíóú"}
#: Attempts after which a surrogate gets longer, so that it always ends distinct.
LENGTHEN = 4


#: Stands around entities while a text is cut; texts that hold it are cut in another way.
MARK = "\ufdd0"


def parts_of(text: Column) -> Column:
    """A text cut at its entities, in one pass: every second part is an entity, and joined they give the text."""
    cut = F.split(F.regexp_replace(text, ANY, f"{MARK}$0{MARK}"), MARK, -1)
    entities = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    other = F.filter(F.flatten(F.zip_with(F.split(text, ANY, -1), entities, lambda a, b: F.array(a, b))), lambda x: x.isNotNull())
    return F.when(F.contains(text, F.lit(MARK)), other).otherwise(cut)


def entities_of(parts: Column) -> Column:
    return F.filter(parts, lambda x, i: i % 2 == 1)


def digits_of(raw: Column) -> Column:
    return F.transform(F.regexp_extract_all(raw, F.lit("[0-9]"), F.lit(0)), lambda x: x.cast("int"))


def luhn_sum(digits: Column) -> Column:
    """Sum of an array of digits, every second from the right doubled and its own digits added."""
    doubled = F.transform(F.reverse(digits), lambda x, i: F.when(i % 2 == 0, x).when(x > 4, x * 2 - 9).otherwise(x * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def has_luhn(raw: Column) -> Column:
    return luhn_sum(digits_of(raw)) % 10 == 0


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern an entity matches; null for a number like a card's that lacks the check digit."""
    kind = F.coalesce(*[F.when(entity.rlike(rf"\A(?:{p})\z"), F.lit(k)) for k, p in PATTERNS.items()], F.lit("phone"))
    return F.when((kind != "card") | has_luhn(entity), kind)


def stream_of(key: str, kind: Column, canon: Column, attempt: Column, length: Column) -> Column:
    """Keyed hex digits, four for each character of a surrogate, and for twelve at least."""
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(length / 16).cast("int")),
        lambda b: F.sha2(F.concat_ws("\u0000", F.lit(key), kind, canon, attempt.cast("string"), b.cast("string")), 256),
    )
    return F.array_join(blocks, "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def number(stream: Column, at: Column) -> Column:
    return F.conv(F.substr(stream, at * 4 + 1, F.lit(4)), 16, 10).cast("int")


def pick(alphabet: str, n: Column) -> Column:
    return F.substr(F.lit(alphabet), n % len(alphabet) + 1, F.lit(1))


def characters(raw: Column) -> Column:
    return F.regexp_extract_all(raw, F.lit("(?s)."), F.lit(0))


def place_of(raw: Column, i: Column) -> Column:
    """How many letters and digits stand before the i-th character."""
    return F.char_length(F.regexp_replace(F.substr(raw, F.lit(1), i), r"[^\p{L}\p{N}]", ""))


def shaped(raw: Column, stream: Column, packed: bool) -> Column:
    """``raw`` with letters and digits replaced in kind: case, script and all other marks stay.

    packed: the n-th letter or digit takes the n-th number, wherever marks stand, so that two
    formats of one number get one surrogate in two formats.
    """
    hexa = raw.rlike(r"\A(?:[0-9a-f]{8,}|[0-9A-F]{8,})\z")

    def one(c: Column, i: Column) -> Column:
        n = number(stream, place_of(raw, i) if packed else i)
        return (
            F.when(c.rlike(r"[0-9]"), (n % 10).cast("string"))
            .when(c.rlike(r"[a-z]"), F.when(hexa, pick("abcdef", n)).otherwise(pick(LOWER, n)))
            .when(c.rlike(r"[A-Z]"), F.when(hexa, pick("ABCDEF", n)).otherwise(pick(UPPER, n)))
            .when(c.rlike(r"[а-яё]"), pick(CYRILLIC, n))
            .when(c.rlike(r"[А-ЯЁ]"), F.upper(pick(CYRILLIC, n)))
            .when(c.rlike(r"\p{Lu}"), F.upper(pick(ACCENTED, n)))
            .when(c.rlike(r"\p{L}"), pick(ACCENTED, n))
            .otherwise(c)
        )

    return F.array_join(F.transform(characters(raw), one), "")


def laid_out(compact: Column, raw: Column) -> Column:
    """The letters and digits of ``compact`` in the places of those of ``raw``."""
    put = lambda c, i: F.when(c.rlike(r"[\p{L}\p{N}]"), F.substr(compact, place_of(raw, i) + 1, F.lit(1))).otherwise(c)
    return F.array_join(F.transform(characters(raw), put), "")


def card_number(raw: Column, stream: Column) -> Column:
    """A number of the same length, first digit and format that has its check digit."""
    old = digits_of(raw)
    body = F.transform(F.slice(old, F.lit(1), F.size(old) - 1), lambda x, i: F.when(i == 0, x).otherwise(number(stream, i) % 10))
    check = (10 - luhn_sum(F.array_append(body, F.lit(0))) % 10) % 10
    return laid_out(F.array_join(F.transform(F.array_append(body, check), lambda x: x.cast("string")), ""), raw)


def iban_number(raw: Column, stream: Column) -> Column:
    """A number of the same country, shape and format that has its check digits."""
    compact = F.regexp_replace(raw, r"[^\p{L}\p{N}]", "")
    country, account = F.substr(compact, F.lit(1), F.lit(2)), shaped(F.substr(compact, F.lit(5)), stream, False)
    values = F.transform(characters(F.concat(account, country, F.lit("00"))), lambda c: F.conv(c, 36, 10).cast("int"))
    rest = F.aggregate(values, F.lit(0), lambda a, x: (F.when(x < 10, a * 10 + x).otherwise(a * 100 + x)) % 97)
    return laid_out(F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account), raw)


def ipv6(raw: Column, stream: Column) -> Column:
    """Groups of as many hexadecimal digits, a gap where ``raw`` has one."""
    lower = F.transform(characters(raw), lambda c, i: F.when(c == ":", c).otherwise(pick("123456789abcdef", number(stream, i))))
    text = F.array_join(lower, "")
    return F.when(raw == F.upper(raw), F.upper(text)).otherwise(text)


def invented(kind: Column, raw: Column, stream: Column, attempt: Column) -> Column:
    """A name of syllables in the script, capitals, accents and marks of ``raw``; the ending of each of its parts tells the gender."""

    def of(at: Column, accents: Column | None, onsets: list[str], vowels: list[str], codas: list[str], endings: tuple[str, str]) -> Column:
        def one(k: Column) -> Column:
            n = number(stream, at + k)
            made = F.concat(*[F.get(F.array(*map(F.lit, x)), (n / step).cast("int") % len(x)) for x, step in ((onsets, 1), (vowels, 16), (codas, 128))])
            return made if accents is None else F.when((k == 0) & accents.isNotNull(), F.call_function("translate", made, F.lit(PLAIN_VOWELS), accents)).otherwise(made)

        length = F.when(kind == "family", 3).otherwise(2) + (attempt / LENGTHEN).cast("int")
        body = F.array_join(F.transform(F.sequence(F.lit(0), length - 1), one), "")
        return F.concat(body, F.when(kind == "given:f", endings[0]).when(kind == "given:m", endings[1]).otherwise(""))

    def part(x: Column, i: Column) -> Column:
        at = i % 7 * 8  # a stream has 64 numbers at least
        accents = F.coalesce(*[F.when(x.rlike(letters), F.lit(new)) for letters, new in ACCENTS.items()])
        latin = of(at, accents, ONSETS, VOWELS, CODAS, ("na", "n"))
        name = F.when(x.rlike(r"\p{IsCyrillic}"), of(at, None, CYRILLIC_ONSETS, CYRILLIC_VOWELS, CYRILLIC_CODAS, ("на", "н"))).otherwise(latin)
        whole = F.when(x == F.upper(x), F.upper(name)).otherwise(F.initcap(name))
        return F.when(F.char_length(x) == 1, shaped(x, F.substr(stream, at * 4 + 1), False)).otherwise(whole)

    marks = F.regexp_extract_all(raw, F.lit("['’-]"), F.lit(0))
    return F.array_join(F.flatten(F.zip_with(F.transform(F.split(raw, "['’-]", -1), part), marks, lambda x, m: F.array(x, F.coalesce(m, F.lit(""))))), "")


def unit_surrogate(key: str, kind: Column, canon: Column, raw: Column, attempt: Column) -> Column:
    """Surrogate of one unit (a name, an address, a number …) in the format of ``raw``.

    Names get longer with the attempts and phone numbers get more digits; other numbers are drawn again, IPv4 addresses
    then from all of them; mailboxes, domains and secrets, which may be as short as a letter, get a suffix.
    """
    head = F.regexp_extract(raw, r"\A(.*)\.", 1)

    late = attempt >= 3 * LENGTHEN

    def made(stream: Column) -> Column:
        first = F.when(late, number(stream, F.lit(0)) % 223 + 1).otherwise(number(stream, F.lit(0)) % 15 + 240)
        octets = F.concat_ws(".", first.cast("string"), *[(number(stream, F.lit(k)) % 256).cast("string") for k in (1, 2, 3)])
        suffix = F.when(late, F.concat(pick(LOWER, number(stream, F.lit(0))), attempt.cast("string"))).otherwise("")
        digits = F.when(late, F.array_join(F.transform(F.sequence(F.lit(3), (attempt / LENGTHEN).cast("int")), lambda k: (number(stream, k) % 10).cast("string")), "")).otherwise("")
        return (
            F.when(kind.isin(*PERSON), invented(kind, raw, stream, attempt))
            .when((kind == "ip") & F.contains(raw, F.lit(".")), octets)
            .when(kind == "ip", ipv6(raw, stream))
            .when(kind == "domain", F.concat(shaped(head, stream, False), suffix, F.lit(".example")))
            .when(kind == "card", card_number(raw, stream))
            .when(kind == "iban", iban_number(raw, stream))
            .when(kind == "ssn", shaped(raw, stream, True))
            .when(kind == "phone", F.concat(shaped(raw, stream, True), digits))
            .otherwise(F.concat(shaped(raw, stream, False), suffix))
        )

    return bound(stream_of(key, kind, canon, attempt, F.greatest(F.char_length(raw), F.lit(48))), made)


def canonical(kind: Column, raw: Column) -> Column:
    return (
        F.when(kind.isin("iban", "ssn", "card", "phone"), F.upper(F.regexp_replace(raw, r"[^\p{L}\p{N}]", "")))
        .when(kind == "secret", raw)
        .otherwise(F.lower(raw))
    )


def pieces(entity: Column) -> Column:
    """An entity as its parts in order: text kept as it is (kind null) and units to replace."""
    kind = kind_of(entity)

    def part(k: Column, raw: Column, canon: Column | None = None, whole: Column | None = None) -> Column:
        told = F.lit(None).cast("string") if whole is None else whole
        return F.struct(k.cast("string").alias("kind"), raw.alias("raw"), (canonical(k, raw) if canon is None else canon).alias("canon"), told.alias("whole"))

    keep = F.lit(None).cast("string")
    local, domain = F.regexp_extract(entity, r"\A(.*)@", 1), F.regexp_extract(entity, r"@(.*)\z", 1)
    email = F.array(
        part(F.concat(F.lit("email:"), F.lower(domain)), local), part(keep, F.lit("@"), F.lit("@")), part(F.lit("domain"), domain)
    )
    opening = F.regexp_extract(entity, rf"\A({ASSIGNED})", 1)
    secret = F.array(part(keep, opening, opening), part(F.lit("secret"), F.substr(entity, F.char_length(opening) + 1)))
    country = F.regexp_extract(entity, r"\A(\+\d{1,3})[ .(-]", 1)
    phone = F.array(part(keep, country, country), part(F.lit("phone"), F.substr(entity, F.char_length(country) + 1)))
    opens = F.regexp_extract(entity, rf"\A((?:{TITLE}){{1,3}}|{LABEL})", 1)
    closes = F.regexp_extract(entity, rf"({AFTER})\z", 1)
    gender = F.when(opens.rlike(rf"(?:\A| )(?:{FEMALE})\.? "), "given:f").when(opens.rlike(rf"(?:\A| )(?:{MALE})\.? "), "given:m").otherwise("given")
    name = F.substr(entity, F.char_length(opens) + 1, F.char_length(entity) - F.char_length(opens) - F.char_length(closes))
    names = F.split(name, " ")
    words = F.transform(
        names,
        lambda x, i: F.array(
            part(keep, F.when(i > 0, " ").otherwise(""), F.lit(" ")),
            part(F.when(x.rlike(r"\A\p{Lu}\.\z"), F.lit(None)).when(i == F.size(names) - 1, "family").otherwise(gender), x, None, F.lower(name)),
        ),
    )
    person = F.concat(F.array(part(keep, opens, opens)), F.flatten(words), F.array(part(keep, closes, closes)))
    whole = F.when(kind.isNull(), F.array(part(keep, entity, entity))).otherwise(F.array(part(kind, entity)))
    return F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "phone", phone).when(kind == "person", person).otherwise(whole)


def settled(units: DataFrame, key: str) -> DataFrame:
    """``units(kind, canon)`` with the attempt whose surrogate is distinct in its kind and no real unit (a name no real name of any kind)."""

    def named(kind: str) -> Column:
        return F.when(F.col(kind).isin(*PERSON), "name").otherwise(F.col(kind)).alias("kind")

    def tried(df: DataFrame) -> DataFrame:
        return staged(df.withColumn("surrogate", unit_surrogate(key, F.col("kind"), F.col("canon"), F.col("canon"), F.col("attempt"))), "surrogates")

    now = tried(units.withColumn("attempt", F.lit(0)))
    while True:
        first = now.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canon")).alias("w"), F.count("*").alias("n")).where("n > 1")
        late = now.join(first, ["kind", "surrogate"]).where("canon <> w.canon").select("kind", "canon")
        real = units.select(named("kind"), F.lower("canon").alias("surrogate")).distinct()
        same = now.select("kind", "canon", named("kind").alias("as"), F.lower("surrogate").alias("surrogate")).join(real.withColumnRenamed("kind", "as"), ["as", "surrogate"], "left_semi")
        same = same.select("kind", "canon")
        again = staged(late.union(same).distinct(), "again")
        if again.isEmpty():
            return now
        more = tried(now.join(again, ["kind", "canon"], "left_semi").select("kind", "canon", (F.col("attempt") + 1).alias("attempt")))
        now = staged(now.join(again, ["kind", "canon"], "left_anti").select(*more.columns).unionByName(more), "surrogates")


def pieces_of(parts: Column) -> Column:
    """The pieces of each entity of a text. A given name whose title tells no gender has that of the same whole name, or
    else of the same given name, where the text first tells it."""

    def told(all_pieces: Column) -> Column:
        return bound(F.filter(F.flatten(all_pieces), lambda u: u["kind"].isin("given:f", "given:m")), lambda known: F.transform(all_pieces, lambda p: F.transform(p, lambda u: one(u, known))))

    def one(u: Column, known: Column) -> Column:
        same = F.get(F.filter(known, lambda k: (k["canon"] == u["canon"]) & (k["whole"] == u["whole"])), F.lit(0))["kind"]
        like = F.get(F.filter(known, lambda k: k["canon"] == u["canon"]), F.lit(0))["kind"]
        return F.when(u["kind"] == "given", u.withField("kind", F.coalesce(same, like, u["kind"]))).otherwise(u)

    return bound(F.transform(entities_of(parts), pieces), told)


def one_gender(units: DataFrame) -> DataFrame:
    """``kind, canon, as``: given names without a gender that have one and only one elsewhere in the corpus, and its kind."""
    known = units.where(F.col("kind").isin("given:f", "given:m")).groupBy("canon").agg(F.min("kind").alias("as"), F.max("kind").alias("other"))
    return units.where("kind = 'given'").join(known.where("as = other").drop("other"), "canon").select("kind", "canon", "as")


def renamed(part: Column, names: Column, pairs: Column) -> Column:
    """The text between entities with its mentions of ``names(raw, new)`` renamed, and their number: ``(text, n)``.

    A word is a mention if it is one of the names; if it is an ordinary word as well (ORDINARY), only
    beside the next or last word of a name (``pairs``).
    """
    pattern = rf"{L}{WORD}{R}"

    def of(cut: Column) -> Column:
        words, between = cut["words"], cut["between"]
        pair = lambda k: F.coalesce((F.get(between, k + 1) == " ") & F.array_contains(pairs, F.concat(F.get(words, k), F.lit(" "), F.get(words, k + 1))), F.lit(False))

        def one(w: Column, k: Column) -> Column:
            new = F.get(F.filter(names, lambda n: n["raw"] == w), F.lit(0))["new"]
            return F.when(~F.lower(w).isin(*[x.lower() for x in ORDINARY]) | pair(k) | pair(k - 1), new)

        def put(new: Column) -> Column:
            written = F.zip_with(F.zip_with(words, new, lambda w, x: F.coalesce(x, w)), F.slice(between, 2, F.size(words)), lambda w, b: F.concat(w, b))
            return F.struct(F.concat(F.get(between, F.lit(0)), F.array_join(written, "")).alias("text"), F.size(F.array_compact(new)).alias("n"))

        return bound(F.transform(words, one), put)

    return bound(F.struct(F.regexp_extract_all(part, F.lit(pattern), F.lit(0)).alias("words"), F.split(part, pattern, -1).alias("between")), of)


def surrogates(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with its text rewritten, and n_entities and entity_kinds (sorted, comma-joined).

    Detected entities (PATTERNS) get keyed surrogates of the same kind and format: letters stay
    letters of their case and script, digits digits, names keep script, capitals, accents, hyphens and the gender
    their title tells, card numbers their first digit and IBANs their country, both with valid check
    digits, mail domains end in .example, IPv4 addresses fall in 240.0.0.0/4. The same
    entity gets the same surrogate in all texts and formats (coreference); a given name whose title tells no gender has
    the one that the text tells elsewhere, or the only one in the corpus. Persons are found by a title, a label before
    or letters after a whole name, or a mail address behind it; each of the names is replaced in the rest of that text too, title or not,
    possessives included, and such mentions count as entities. Names that are ordinary words (ORDINARY: months, modals …) are replaced
    in whole names only. Initials stay. Numbers like a card's without its check digit are left alone. The distinct units of
    the corpus are checked: where two would share a surrogate, or one equals a real unit, the later
    tries again until all are distinct; only those few are joined back to their documents. Each text is cut
    once and written with its entities apart; no other text moves, and of those with entities only
    where a unit tried again or took the gender of another text.

    Null text stays null, with no entities; other columns are kept as they are, whatever their names (earlier ones named
    n_entities or entity_kinds are replaced). Repeated rows get
    the same text; an empty table gives an empty result.
    """
    names = [c for c in docs.columns if c not in ("n_entities", "entity_kinds")]
    text = text_of(f"`{text_col}`")
    # the caller's columns stand in a struct, so that none of them clashes with those used here
    cut = docs.select(F.struct(*[F.col(f"`{c}`") for c in names if c != text_col], F.lit(0).alias(text_col)).alias("own"), F.col(f"`{text_col}`").cast("string").alias("text"), F.when(text.rlike(HINT), parts_of(text)).alias("parts"))
    cut = cut.withColumn("parts", F.when(F.size("parts") > 1, F.col("parts"))).withColumn("row", F.monotonically_increasing_id())
    cut = staged(cut.withColumn("text", F.when(F.col("parts").isNull(), F.col("text"))), "cut-texts")
    marked = cut.where(F.col("parts").isNotNull())
    units_of = F.filter(F.flatten(pieces_of(F.col("parts"))), lambda u: u["kind"].isNotNull())
    seen = marked.select("row", F.explode(units_of).alias("u")).select("row", "u.kind", "u.canon").distinct()
    units = staged(seen.select("kind", "canon").distinct(), "units")
    turned = staged(one_gender(units), "genders")
    some_turned = not turned.isEmpty()
    final = settled(units.join(turned, ["kind", "canon"], "left_anti") if some_turned else units, key)
    changed = final.where("attempt > 0").select("kind", "canon", F.col("kind").alias("as"), "attempt")
    if some_turned:
        changed = changed.unionByName(turned.join(final.select(F.col("kind").alias("as"), "canon", "attempt"), ["as", "canon"]))
    changed = staged(changed, "changed")
    name = F.concat_ws("\u0000", F.col("kind"), F.col("canon"))
    some_changed = not changed.isEmpty()
    if some_changed:
        base = seen.join(changed, ["kind", "canon"]).groupBy("row")
        base = staged(base.agg(F.map_from_entries(F.collect_list(F.struct(name, F.struct("as", "attempt")))).alias("changes")), "changes")
        marked = marked.join(base, "row", "left")

    def written(u: Column) -> Column:
        kind, attempt = u["kind"], F.lit(0)
        if some_changed:
            change = F.try_element_at(F.col("changes"), F.concat_ws("\u0000", u["kind"], u["canon"]))
            kind, attempt = F.coalesce(change["as"], kind), F.coalesce(change["attempt"], attempt)
        return F.when(u["kind"].isNull(), u["raw"]).otherwise(unit_surrogate(key, kind, u["canon"], u["raw"], attempt))

    told = marked.withColumns({"kinds": F.transform(entities_of(F.col("parts")), kind_of), "pieces": pieces_of(F.col("parts"))})
    persons = F.transform("pieces", lambda p: F.filter(p, lambda u: u["kind"].isin(*PERSON)))
    pairs = F.flatten(F.transform("persons", lambda p: F.zip_with(F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), lambda a, b: F.concat(a["raw"], F.lit(" "), b["raw"]))))
    told = told.withColumn("persons", persons).withColumns(
        {"pairs": pairs, "names": F.array_distinct(F.transform(F.flatten("persons"), lambda u: F.struct(u["raw"].alias("raw"), written(u).alias("new"))))}
    )
    new = F.transform("pieces", lambda p: F.array_join(F.transform(p, written), ""))
    plain = lambda x: F.struct(x.alias("text"), F.lit(0).alias("n"))
    rest = F.transform(F.filter("parts", lambda x, i: i % 2 == 0), lambda x: F.when(F.size("names") > 0, renamed(x, F.col("names"), F.col("pairs"))).otherwise(plain(x)))
    told = told.withColumns({"new": new, "rest": rest})
    mentions = F.aggregate("rest", F.lit(0), lambda a, x: a + x["n"])
    joined = F.array_join(F.zip_with("rest", "new", lambda a, b: F.concat(a["text"], F.coalesce(b, F.lit("")))), "")
    kinds = F.array_compact(F.col("kinds"))
    own = lambda text: [text.alias(c) if c == text_col else F.col("own").getField(c).alias(c) for c in names]
    rewritten = told.select(
        *own(joined), (F.size(kinds) + mentions).cast("long").alias("n_entities"), F.array_join(F.array_sort(F.array_distinct(kinds)), ",").alias("entity_kinds")
    )
    untouched = cut.where(F.col("parts").isNull()).select(*own(F.col("text")), F.lit(0).cast("long").alias("n_entities"), F.lit("").alias("entity_kinds"))
    return untouched.union(rewritten)


def replaced(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs`` with surrogates in their text and its new length, in the same columns."""
    out = surrogates(docs, key, id_col, text_col)
    if size_col in docs.columns:
        out = out.withColumn(size_col, F.char_length(text_col).cast(dict(docs.dtypes)[size_col]))
    return out.select(*docs.columns)
