"""Surrogates for personal data: keyed, of the same type and format, distinct, the same for each mention.

Everything on this path is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import stored

# Titles that tell the gender of the person they precede.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "господин", "г-н", "κύριος")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "госпожа", "г-жа", "κυρία")
NEUTRAL_TITLES = ("Dr", "Prof")

# What surrogate names are made of, by script. A given name is a stem and an ending of its gender.
LATIN = ("ba be bo da de do fa fe fi ga ge ka ke ko la le lo ma me mo na ne no pa pe po ra re ro sa se so ta te to va ve vo za".split(),
         {"m": ["n", "rt", "s", "ld"], "f": ["a", "ia", "ina", "elle"], "u": ["y", "e", "is", "o"], "s": ["mann", "well", "ton", "berg"]})
CYRILLIC = ("ба бе бо ва ве во га да де до за ка ко ла ле ло ма ме мо на не но па по ра ре ро са се со та те то фа".split(),
            {"m": ["н", "слав", "мир", "р"], "f": ["на", "ла", "я", "ина"], "u": ["и", "о", "ша", "ня"], "s": ["ко", "ский", "ян", "юк"]})
GREEK = ("βα βε γα δα δε θα κα κε κο λα λε λο μα με μο να νε νο πα πε πο ρα ρε ρο σα σε σο τα τε το φα".split(),
         {"m": ["ης", "ος", "ας", "ων"], "f": ["α", "η", "ια", "ω"], "u": ["ι", "ο", "ου", "υ"], "s": ["ίδης", "άκης", "όπουλος", "ίου"]})

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_TITLE = "(?:" + "|".join((*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES)) + ")"
# Titles that may follow another one; "Don" may be a given name there.
_STACKED = "(?:" + "|".join(t for t in (*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES) if t not in ("Don", "Doña")) + ")"
_DEGREE = r"(?:(?:med|dent|vet|phil|jur|iur|rer|nat|pol|oec|theol|habil|mult|ing|h\. ?c)\. )"
_TITLES = rf"{_TITLE}\.? (?:{_STACKED}\.? |{_DEGREE}){{0,8}}"
_PARTICLE = "(?:(?:von|vom|van|der|den|dem|de|del|della|di|da|do|dos|das|du|des|la|le|lo|el|al|bin|ibn|ben|zu|zum|zur|ter|ten|te|af|av|y) )"
# A name word ends before 's; titles and suffixes such as Jr are none.
_NOT_NAME = rf"(?!(?:{_STACKED}|Jr|II|III|IV)(?![\p{{L}}\p{{M}}'’-]))"
WORD = r"(?:[dl]['’]|[ae]l-)?+\p{Lu}[\p{L}\p{M}]*+(?:['’-](?!s(?![\p{L}\p{M}]))[\p{L}\p{M}]++)*+"
_PART = rf"{_PARTICLE}{{0,4}}+{_NOT_NAME}(?:\p{{Lu}}\.|{WORD})"
# Patterns by type; each starts behind something it could not begin with,
# and every repetition is bounded or possessive, so that a scan stays linear in the text.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])"
# A secret reaches to the next quote or white space, whatever its length.
# These two start with the `=` or quote before them: no other type starts so, and that character tells the branch.
PASSWORD = r"(?<=password)=[^\s\"']++"
TOKEN = r"(?<=token = )\"[^\s\"']{16,}+"
ACCESS_KEY = r"AKIA[0-9A-Z]{16}(?![0-9A-Z])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?\d{1,3})?(?![A-Za-z0-9])"
IP = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])(?:\d{16}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4})(?![\d-])"
PHONE = r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\d-])|(?<![\d+])\+\d{8,14}(?!\d)"
PERSON = rf"(?<![\p{{L}}\d]){_TITLES}{_PART}(?:(?: |(?<=\.)-?){_PART})*+"
NAME_WORD = rf"(?<![\p{{L}}\p{{M}}\d]){WORD}(?!\d)"  # what may be a bare mention
# Capitalised at the start of a sentence: never a bare mention, though a name word behind a title.
FUNCTION_WORDS = """a an and as at but for from he her his i if in is it of on or she so that the then they this to we what when who you
    der die das den dem ein eine er sie es ich wir und oder aber im in am auf zu mit von le la les un une il elle et en de du des el los las y o
    él ella и в на он она они это ο η το οι και""".split()
# Without one of these a text holds no entity; nearly every position fails on its first character.
HINT = rf"[0-9@]|AKIA|password=|token = |(?=[MHSDFPгκ])(?<![\p{{L}}\d]){_TITLE}\.? \p{{L}}"
# In order of preference; what a match starts with and is made of tells its branch, see ``kind_of``.
ENTITY = "|".join((PASSWORD, TOKEN, EMAIL, ACCESS_KEY, IBAN, IP, SSN, CARD, PHONE, PERSON))

TRIES = 8  # attempts within a format; after them a surrogate grows by the rank of its original
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = "!#$%&*:;?^~"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: without it, expressions that use a value often grow beyond bounds."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _plain(value: Column, keep: str) -> Column:
    return F.regexp_replace(value, keep, "")


def kind_of(mention: Column) -> Column:
    """The type whose pattern matched: passwords and tokens carry a mark in front, and the other forms exclude each other."""
    starts = {"given_m": MALE_TITLES, "given_f": FEMALE_TITLES, "given_u": NEUTRAL_TITLES}
    titled = reduce(
        lambda chain, item: chain.when(mention.rlike(r"^(?:(?:Dr|Prof)\.? ){0,8}(?:" + "|".join(item[1]) + r")\.? "), F.lit(item[0])), starts.items(),
        F.when(mention.rlike("^[=\"]"), F.lit("secret")).when(mention.contains("@"), F.lit("email")),
    )
    return (
        titled.when(mention.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), F.lit("ip"))
        .when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), F.lit("ssn"))
        .when(mention.rlike(r"^\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}$"), F.lit("card"))
        .when(mention.startswith("AKIA"), F.lit("secret"))
        .when(mention.rlike("^[A-Z]"), F.lit("iban"))
        .otherwise(F.lit("phone"))
    )


def _unmarked(mention: Column) -> Column:
    return F.regexp_replace(mention, "^[=\"]", "")


def script_of(name: Column) -> Column:
    return F.when(name.rlike(r"\p{IsCyrillic}"), F.lit("c")).when(name.rlike(r"\p{IsGreek}"), F.lit("g")).otherwise(F.lit("l"))


def name_words(mention: Column) -> Column:
    """Words and initials of a titled name, without titles and particles."""
    return F.regexp_extract_all(F.regexp_replace(mention, f"^{_TITLES}", ""), F.lit(WORD), F.lit(0))


def units_of(mention: Column) -> Column:
    """What a mention names, as (kind, canon): two spellings of one entity give one unit.

    A titled name gives one unit a word: given names by gender, the last word as surname. So
    "Frau Eva Berg" and "Frau Berg" share the surname's surrogate. A single letter is an
    initial: it becomes another letter by the key, but names nothing by itself. Titles and
    particles are not part of a name.
    """
    words = name_words(mention)

    def of(kind: Column) -> Column:
        def named(x: Column) -> Column:
            return F.transform(x["words"], lambda word, k: F.struct(
                F.concat(F.when(F.length(word) == 1, F.lit("initial")).when(k == x["last"], F.lit("surname")).otherwise(kind), F.lit("_"), script_of(word)).alias("kind"),
                F.lower(word).alias("canon")))

        long = F.array_max(F.transform(words, lambda word, k: F.when(F.length(word) > 1, k)))
        canon = (
            F.when(kind == "email", F.lower(mention))
            .when(kind.isin("phone", "card", "ssn"), _plain(mention, r"\D"))
            .when(kind == "iban", _plain(mention, " "))
            .when(kind == "secret", _unmarked(mention))
            .otherwise(mention)
        )
        return F.when(kind.startswith("given"), _let(F.struct(words.alias("words"), long.alias("last")), named)).otherwise(F.array(F.struct(kind.alias("kind"), canon.alias("canon"))))

    return _let(kind_of(mention), of)


def _stream(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """256 keyed hex digits for one original and attempt."""
    seed = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    return F.concat(F.sha2(F.concat(seed, F.lit("|0")), 512), F.sha2(F.concat(seed, F.lit("|1")), 512))


def _at(stream: Column, k: Column, below: int) -> Column:
    """Number ``k`` of the stream, in 0 .. below - 1."""
    return F.pmod(F.conv(F.substring(stream, F.pmod(k * 4, F.lit(252)) + 1, 4), 16, 10).cast("int"), F.lit(below))


def _pick(alphabet: str | list[str], stream: Column, k: Column) -> Column:
    if isinstance(alphabet, str):
        return F.substring(F.lit(alphabet), _at(stream, k, len(alphabet)) + 1, F.lit(1))
    return F.element_at(F.array(*map(F.lit, alphabet)), _at(stream, k, len(alphabet)) + 1)


def _like(value: Column, stream: Column, lower: str = LOWER) -> Column:
    """Digits become digits and letters letters of their case; every other character stays."""
    return F.array_join(F.transform(F.split(value, ""), lambda c, k: (
        F.when(c.rlike("^[0-9]$"), _pick(DIGITS, stream, k))
        .when(c.rlike("^[a-z]$"), _pick(lower, stream, k))
        .when(c.rlike("^[A-Z]$"), _pick(UPPER, stream, k))
        .otherwise(c))), "")


def _secret(canon: Column, stream: Column) -> Column:
    """Every character is drawn again, symbols too; only the dots and equal signs of a long token stay, which are its form."""
    token = canon.rlike(r"^[0-9A-Za-z._~+/=-]{16,}$") & canon.rlike("^(?:[^0-9A-Za-z]*[0-9A-Za-z]){8}")

    def drawn(c: Column, k: Column) -> Column:
        return (
            F.when(c.rlike("^[0-9]$"), _pick(DIGITS, stream, k))
            .when(c.rlike("^[a-z]$"), _pick(LOWER, stream, k))
            .when(c.rlike("^[A-Z]$"), _pick(UPPER, stream, k))
            .when(c.rlike(r"^\p{Lu}$"), _pick(UPPER, stream, k))
            .when(c.rlike(r"^\p{L}$"), _pick(LOWER, stream, k))
            .when(c.rlike(r"^\p{N}$"), _pick(DIGITS, stream, k))
            .when(token & c.rlike("^[.=]$"), c)
            .when(c.isin("-", "_"), _pick("-_", stream, k))
            .when(c.isin("+", "/"), _pick("+/", stream, k))
            .otherwise(_pick(SYMBOLS, stream, k)))

    return F.array_join(F.transform(F.split(canon, ""), drawn), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of 16 digits."""
    doubled = F.transform(F.split(digits, ""), lambda c, k: (
        F.when(k % 2 == 0, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int"))))
    return F.aggregate(doubled, F.lit(0), lambda a, b: a + b) % 10


def _name(kind: Column, stream: Column) -> Column:
    """A made-up lower-case name of the word's script, with an ending of its gender or of surnames."""

    def of(script: tuple) -> Column:
        syllables, endings = script
        ends = reduce(lambda chain, g: chain.when(kind.startswith(g[0]), _pick(endings[g[1]], stream, F.lit(9))),
                      [("given_m", "m"), ("given_f", "f"), ("given_u", "u")], F.when(kind.startswith("surname"), _pick(endings["s"], stream, F.lit(9))))
        return F.concat(*[_pick(syllables, stream, F.lit(k)) for k in range(3)], ends)

    return F.when(kind.endswith("_c"), of(CYRILLIC)).when(kind.endswith("_g"), of(GREEK)).otherwise(of(LATIN))


def _initial(kind: Column, canon: Column, stream: Column) -> Column:
    """Another letter of the script, never the same."""

    def of(letters: str) -> Column:
        at = F.instr(F.lit(letters), canon)
        return F.substring(F.lit(letters), F.pmod(at + _at(stream, F.lit(0), len(letters) - 1), F.lit(len(letters))) + 1, F.lit(1))

    return F.when(kind.endswith("_c"), of("абвгдезиклмнопрстуфхэюя")).when(kind.endswith("_g"), of("αβγδεζηθικλμνξοπρστυφχψω")).otherwise(of(LOWER))


def _email(canon: Column, stream: Column, host_stream: Callable[[Column], Column]) -> Column:
    """Another local part; of the host, what is not a reserved example domain or the top domain is redrawn."""

    def of(host: Column) -> Column:
        tail = F.when(host.rlike(r"(^|\.)example\.(com|org|net)$"), F.regexp_extract(host, r"example\.[a-z]+$", 0)).otherwise(
            F.concat(F.lit("."), F.substring_index(host, ".", -1)))
        front = F.substring(host, F.lit(1), F.length(host) - F.length(tail))
        return _let(front, lambda f: F.concat(_let(host_stream(f), lambda own: _like(f, own)), tail))

    return F.concat(_like(F.substring_index(canon, "@", 1), stream), F.lit("@"), _let(F.substring_index(canon, "@", -1), of))


def surrogate_of(key: str, kind: Column, canon: Column, attempt: Column) -> Column:
    """Canonical surrogate of an original: same type, same form, drawn by the secret key."""

    def number(kind: Column, canon: Column, stream: Column, digits: Column) -> Column:
        card = F.concat(F.substring(canon, 1, 1), F.substring(digits, 2, 14))
        check = _let(card, lambda c: F.concat(c, F.substring(
            F.lit(DIGITS), F.pmod(_luhn(canon) - _luhn(F.concat(c, F.lit("0"))), F.lit(10)) + 1, F.lit(1))))
        northern = F.concat(F.lit("1"), _pick("23456789", stream, F.lit(1)), F.substring(digits, 3, 2), F.lit("555"), F.substring(digits, 8, 4))
        phone = F.when(canon.rlike(r"^1\d{10}$"), northern).otherwise(digits)
        return F.when(kind == "card", check).when(kind == "phone", phone).otherwise(F.concat(F.lit("9"), F.substring(digits, 2, 8)))

    def of(x: Column) -> Column:
        kind, canon, stream = x["kind"], x["canon"], x["stream"]
        octets = [(_at(stream, F.lit(k), 256) if k else _at(stream, F.lit(0), 223) + 1).cast("string") for k in range(4)]
        secret = F.when(canon.rlike("^AKIA[0-9A-Z]{16}$"), F.concat(F.lit("AKIA"), _like(F.substring(canon, 5, 16), stream)))
        secret = secret.when(canon.rlike("^[0-9a-f]+$"), _like(canon, stream, "abcdef")).otherwise(_secret(canon, stream))
        iban = F.concat(F.substring(canon, 1, 2), F.substring(_like(canon, stream), 3, 40))
        numbers = _let(_like(canon, stream), lambda digits: number(kind, canon, stream, digits))
        made = F.when(kind == "email", _email(canon, stream, lambda front: _stream(key, F.lit("host"), front, attempt)))
        made = made.when(kind == "ip", F.concat_ws(".", *octets)).when(kind.isin("card", "phone", "ssn"), numbers)
        return made.when(kind == "secret", secret).when(kind == "iban", iban).when(kind.startswith("initial"), _initial(kind, canon, stream)).otherwise(_name(kind, stream))

    return _let(F.struct(kind.alias("kind"), canon.alias("canon"), _stream(key, kind, canon, attempt).alias("stream")), of)


def _longer(kind: Column, made: Column, rank: Column) -> Column:
    """A surrogate no shorter attempt can equal, for formats with too few values: it grows by its rank."""
    tag = F.concat(F.lit("0"), rank.cast("string"))
    letters = F.translate(tag, DIGITS, "qwxzvkjyhu")
    local, host = F.substring_index(made, "@", 1), F.substring_index(made, "@", -1)
    return F.when(kind == "email", F.concat(local, F.lit("."), tag, F.lit("@"), host)).when(
        kind.rlike("^(given|surname)"), F.concat(made, letters)).otherwise(F.concat(made, tag))


def resolve(units: DataFrame, key: str, tries: int = TRIES) -> DataFrame:
    """(kind, canon, surrogate) of those units whose first draw cannot stay.

    A draw cannot stay if it equals an original that occurs in the texts or a surrogate that
    went to another unit. Its unit draws again; what still collides after ``tries`` draws grows
    by its rank, which sets it apart from everything of fixed form.
    """
    units = units.select("kind", "canon")
    spark, taken, moved = units.sparkSession, None, []
    waiting = units.withColumn("tries", F.lit(0))
    for attempt in range(tries + 1):
        made = surrogate_of(key, F.col("kind"), F.col("canon"), F.lit(attempt))
        drawn = waiting.withColumn("made", made)
        if attempt == tries:
            rank = F.xxhash64("kind", "canon").bitwiseAND((1 << 62) - 1)
            drawn = drawn.withColumn("made", _longer(F.col("kind"), F.col("made"), rank))
        drawn = drawn.withColumn("kept", F.row_number().over(Window.partitionBy("kind", "made").orderBy(F.xxhash64("canon"), "canon")) == 1)
        originals = units.select("kind", F.col("canon").alias("made"), F.lit(True).alias("real"))
        drawn = drawn.join(originals, ["kind", "made"], "left")
        if taken is not None:
            drawn = drawn.join(taken.select("kind", "made", F.lit(True).alias("used")), ["kind", "made"], "left")
        else:
            drawn = drawn.withColumn("used", F.lit(None).cast("boolean"))
        free = F.col("kept") & F.col("real").isNull() & F.col("used").isNull()
        if attempt == tries:
            free = F.lit(True)
        drawn = stored(drawn.select("kind", "canon", "made", free.alias("free")), "surrogates")
        done = drawn.filter("free")
        if attempt:
            moved.append(done.select("kind", "canon", F.col("made").alias("surrogate")))
        waiting = drawn.filter("not free").select("kind", "canon", F.lit(attempt + 1).alias("tries"))
        if waiting.isEmpty():
            break
        taken = done.select("kind", "made") if taken is None else taken.union(done.select("kind", "made"))
    if moved:
        return reduce(DataFrame.union, moved)
    return spark.createDataFrame([], "kind string, canon string, surrogate string")


def _pour(form: Column, digits: Column) -> Column:
    """Write digits into a form: each digit of the form takes the next one, the rest follow at the end."""
    chars = F.split(form, "")
    count = F.length(_plain(form, r"\D"))
    start = F.struct(F.lit(0).alias("n"), F.lit("").alias("out"))
    poured = F.aggregate(chars, start, lambda state, c: F.when(c.rlike(r"^\d$"), F.struct(
        (state["n"] + 1).alias("n"), F.concat(state["out"], F.substring(digits, state["n"] + 1, F.lit(1))).alias("out"),
    )).otherwise(F.struct(state["n"].alias("n"), F.concat(state["out"], c).alias("out"))))["out"]
    return F.concat(poured, F.substring(digits, count + 1, F.lit(64)))


def _cased(word: Column, form: Column) -> Column:
    return F.when((form == F.upper(form)) & (F.length(form) > 1), F.upper(word)).otherwise(F.initcap(word))


def _woven(pieces: Column, between: Column) -> Column:
    return F.array_join(F.zip_with(pieces, between, lambda piece, made: F.concat(piece, F.coalesce(made, F.lit("")))), "")


def names_in(mentions: Column, moved: Column, key: str) -> Column:
    """Name words of all titled mentions of a text, as distinct (canon, made); a word that is both counts as surname."""

    def named(unit: Column) -> Column:
        made = F.coalesce(F.element_at(moved, F.concat_ws("|", unit["kind"], unit["canon"])),
                          _name(unit["kind"], _stream(key, unit["kind"], unit["canon"], F.lit(0))))
        return F.struct(unit["canon"].alias("canon"), made.alias("made"))

    titled = F.filter(mentions, lambda m: kind_of(m).startswith("given"))
    units = F.filter(F.flatten(F.transform(titled, units_of)), lambda u: u["kind"].rlike("^(given|surname)") & ~u["canon"].isin(*FUNCTION_WORDS))
    ranked = F.array_sort(F.array_distinct(F.transform(units, lambda u: F.struct(
        u["canon"].alias("canon"), (~u["kind"].startswith("surname")).alias("given"), u["kind"].alias("kind")))))
    one = _let(ranked, lambda r: F.filter(r, lambda u, k: (k == 0) | (u["canon"] != F.get(r, k - 1)["canon"])))
    return F.transform(one, named)


def replaced_text(body: Column, moved: Column, key: str) -> Column:
    """(text, n): the text with surrogates for its mentions and for bare mentions of the names among them, and their number."""

    def bare(piece: Column, names: Column) -> Column:
        """The piece between two mentions, with each word that is a name of this text replaced."""
        words = F.regexp_extract_all(piece, F.lit(NAME_WORD), F.lit(0))
        made = F.transform(words, lambda word: F.coalesce(_cased(F.element_at(names, F.lower(word)), word), word))
        hits = F.size(F.filter(words, lambda word: F.map_contains_key(names, F.lower(word))))
        return F.struct(_woven(F.split(piece, NAME_WORD, -1), made).alias("text"), hits.alias("n"))

    def of(mentions: Column) -> Column:
        new = F.transform(mentions, lambda mention: rendered(mention, moved, key))
        pieces = F.split(body, ENTITY, -1)
        plain = F.struct(_woven(pieces, new).alias("text"), F.size(mentions).alias("n"))

        def with_names(names: Column) -> Column:
            done = F.transform(pieces, lambda piece: bare(piece, names))
            return _let(done, lambda d: F.struct(
                _woven(F.transform(d, lambda x: x["text"]), new).alias("text"),
                (F.size(mentions) + F.aggregate(d, F.lit(0), lambda n, x: n + x["n"])).alias("n")))

        titled = F.exists(mentions, lambda m: m.rlike(f"^{_TITLE}\\.? "))
        return F.when(titled, _let(F.map_from_entries(names_in(mentions, moved, key)), with_names)).otherwise(plain)

    return _let(mentions_of(body), of)


def rendered(mention: Column, moved: Column, key: str) -> Column:
    """The mention with its surrogate in its own format; ``moved`` maps kind|canon to redrawn surrogates."""

    def of(unit: Column) -> Column:
        first = surrogate_of(key, unit["kind"], unit["canon"], F.lit(0))
        return F.coalesce(F.element_at(moved, F.concat_ws("|", unit["kind"], unit["canon"])), first)

    def numbered(form: Column, kind: Column, one: Column) -> Column:
        mail = F.when(form == F.upper(form), F.upper(one)).otherwise(one)
        spaced = F.when(form.contains(" "), F.trim(F.regexp_replace(one, "(.{4})", "$1 "))).otherwise(one)
        marked = F.concat(F.regexp_extract(form, "^[=\"]", 0), one)
        return F.when(kind == "secret", marked).when(kind == "email", mail).when(kind.isin("phone", "card", "ssn"), _pour(form, one)).when(kind == "iban", spaced).otherwise(one)

    def person(form: Column, made: Column) -> Column:
        tail = F.regexp_replace(form, f"^{_TITLES}", "")
        return F.concat(F.regexp_extract(form, f"^{_TITLES}", 0), _woven(F.split(tail, WORD, -1), F.zip_with(made, name_words(form), _cased)))

    def of_units(x: Column) -> Column:
        first = F.element_at(x["units"], 1)["kind"]
        return F.when(first.rlike("^(given|surname|initial)"), person(x["form"], x["made"])).otherwise(
            numbered(x["form"], first, F.element_at(x["made"], 1)))

    drawn = _let(F.struct(mention.alias("form"), units_of(mention).alias("units")), lambda x: F.struct(
        x["form"].alias("form"), x["units"].alias("units"), F.transform(x["units"], of).alias("made")))
    return _let(drawn, of_units)


def mentions_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))


def surrogates(documents: DataFrame, key: str, text: str = "text", counts: str | None = None) -> DataFrame:
    """The documents with every detected entity replaced in ``text``.

    A name is detected behind a title; its words are then replaced wherever they stand alone in
    the same text, before or after. The README lists what is not detected.

    Replacements depend on the key and the entity alone, so an entity has one surrogate in all
    documents; distinct entities of a kind have distinct ones, none of which is an original of
    the corpus. With ``counts``, a column of that name tells the number of replaced mentions.
    Null texts stay null, empty ones empty; texts without entities, repeated rows and all other
    columns pass unchanged. Only narrow rows (hash of the text, entity) are shuffled; texts are
    joined by hash with the few redrawn surrogates. An empty table gives an empty result.
    """
    body = F.col(text)
    digest = F.sha2(body.cast("binary"), 256)
    hint = F.regexp_like(body, F.lit(HINT))
    found = documents.filter(hint).select(body.alias("body"))
    units = F.array_distinct(F.flatten(F.transform(mentions_of(F.col("body")), units_of)))
    seen = found.select(F.sha2(F.col("body").cast("binary"), 256).alias("hash"), F.explode(units).alias("unit"))
    seen = stored(seen.select("hash", "unit.kind", "unit.canon").filter(~F.col("kind").startswith("initial")), "mentions")
    redrawn = resolve(seen.select("kind", "canon").distinct(), key)
    entries = F.collect_set(F.struct(F.concat_ws("|", "kind", "canon").alias("k"), F.col("surrogate").alias("v")))
    by_text = seen.distinct().join(redrawn, ["kind", "canon"]).groupBy("hash").agg(F.map_from_entries(entries).alias("moved"))
    by_text = stored(by_text, "redrawn").select(F.col("hash").alias("__hash"), F.col("moved").alias("__moved"))
    rows = documents.join(by_text, digest == F.col("__hash"), "left")
    moved = F.coalesce(F.col("__moved"), F.create_map().cast("map<string,string>"))
    done = F.when(hint, replaced_text(body, moved, key)).otherwise(F.struct(body.alias("text"), F.lit(0).alias("n")))
    names = [name for name in documents.columns if name != counts]
    rows = rows.select(*[F.col(name) for name in names], done.alias("__done"))
    columns = [F.col("__done.text").alias(text) if name == text else F.col(name) for name in names]
    return rows.select(*columns, *([F.coalesce("__done.n", F.lit(0)).alias(counts)] if counts else []))
