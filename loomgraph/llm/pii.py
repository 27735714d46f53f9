"""Surrogates for personal data, in DataFrame functions only."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop, stage, unpacked, whole_row

#: Titles and usual English, German, French and Spanish given names by gender, without names that are also
#: places or common words.
TITLES = {"m": "Mr Herr Monsieur Señor Signor Господин Κύριος".split(), "f": "Mrs Ms Miss Frau Madame Mme Señora Signora Госпожа Κυρία".split(), "n": "Dr Prof".split()}
GIVEN = {
    "m": """
        James John Robert Michael William David Thomas Charles Daniel Matthew Anthony Donald Steven Stephen Paul Andrew Joshua Kenneth Kevin Brian George
        Timothy Ronald Edward Jason Jeffrey Ryan Jacob Gary Nicholas Eric Jonathan Larry Justin Scott Brandon Benjamin Samuel Gregory Alexander Patrick
        Raymond Dennis Jerry Tyler Aaron Adam Nathan Henry Douglas Zachary Peter Kyle Ethan Jeremy Walter Keith Roger Terry Harry Sean Gerald Carl Arthur
        Lawrence Albert Philip Simon Oliver Liam Noah Lucas Logan Oscar Alan Neil Ian Graham Martin Joseph Christopher Richard Hans Karl Jürgen Wolfgang Klaus
        Heinz Helmut Manfred Günter Günther Gerhard Horst Dieter Werner Uwe Bernd Rainer Holger Jörg Thorsten Torsten Stefan Andreas Matthias Markus Sebastian
        Tobias Florian Johannes Jens Sven Ulrich Heinrich Friedrich Wilhelm Otto Hermann Fritz Franz Josef Ludwig Georg Kurt Erich Ernst Rolf Rudolf Siegfried
        Felix Lukas Jonas Leon Moritz Niklas Dirk Olaf Norbert Hartmut Lothar Pierre Jean Luc Michel Philippe Alain Bernard Jacques Christophe Nicolas Laurent
        Patrice Julien François Frédéric Sébastien Stéphane Thierry Pascal Éric Olivier Gérard Guillaume Antoine Vincent Jérôme Bruno Claude Didier Dominique
        Gilles Hervé Yves Xavier Mathieu Maxime Romain Benoît Marcel André René Louis Étienne Hugo Théo Gaël Jules Raphaël Fabrice Cédric Ludovic Emmanuel
        Rémi Damien Carlos José Juan Miguel Antonio Manuel Francisco Javier Jesús Alejandro Rafael Pedro Fernando Sergio Pablo Jorge Alberto Luis Álvaro Diego
        Adrián Raúl Enrique Ramón Vicente Iván Rubén Óscar Andrés Joaquín Eduardo Víctor Roberto Jaime Mario Ignacio Marcos Ricardo Emilio Julián Julio
        Guillermo Tomás Agustín Felipe Gonzalo Nicolás Martín Gabriel Mateo Иван Сергей Дмитрий Γιώργος Νίκος
    """.split(),
    "f": """
        Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Lisa Nancy Betty Margaret Sandra Ashley Kimberly Emily Donna Michelle Carol
        Amanda Dorothy Melissa Deborah Stephanie Rebecca Sharon Laura Cynthia Kathleen Amy Angela Shirley Brenda Emma Anna Pamela Nicole Samantha Katherine
        Christine Helen Debra Rachel Carolyn Janet Maria Catherine Heather Diane Olivia Julie Joyce Ruth Kelly Lauren Christina Joan Evelyn Judith Andrea
        Hannah Megan Cheryl Jacqueline Martha Teresa Sara Janice Ann Kathryn Abigail Sophia Frances Alice Judy Isabella Julia Denise Doris Marilyn Danielle
        Beverly Charlotte Natalie Theresa Diana Brittany Kayla Alexis Lori Marie Chloe Lucy Jane Anne Fiona Claire Ursula Ingrid Monika Petra Sabine Renate
        Helga Karin Brigitte Erika Christa Gisela Susanne Birgit Gabriele Heike Martina Kerstin Silke Katrin Kathrin Anja Tanja Claudia Nadine Stefanie Simone
        Daniela Melanie Sonja Angelika Elke Bärbel Jutta Hildegard Gertrud Irmgard Elfriede Ilse Johanna Lena Lea Leonie Franziska Katharina Lieselotte Ute
        Anke Antje Marion Cornelia Heidi Elisabeth Margarete Hannelore Waltraud Nathalie Isabelle Sylvie Françoise Valérie Monique Véronique Sandrine Céline
        Sophie Chantal Annie Stéphanie Virginie Aurélie Camille Léa Manon Chloé Inès Élodie Émilie Amélie Hélène Laurence Corinne Martine Michèle Jeanne
        Madeleine Yvette Geneviève Odile Mathilde Margaux Juliette Lucie Pauline Agnès Delphine Élise Éléonore Thérèse María Carmen Lucía Josefa Isabel Ana
        Cristina Marta Francisca Antonia Elena Paula Raquel Pilar Silvia Juana Beatriz Nuria Irene Montserrat Sofía Alicia Sonia Esther Ángela Marina Natalia
        Yolanda Eva Inés Noelia Verónica Lorena Dolores Manuela Margarita Catalina Susana Valeria Carolina Adriana Luisa Анна Мария Ольга Ελένη Μαρία
    """.split(),
}
#: Syllables and endings of made-up names by script; endings of given names by gender.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve vo za".split(),
    "cyrillic": "ба бе бо да де до ва ве га го ка ко ла ле ло ма ме мо на не но па ре ро са се та те".split(),
    "greek": "βα βε βο γα γο δα δε κα κο λα λε μα με μο να νε νο πα πε ρα ρε σα σε τα τε".split(),
}
ENDINGS = {
    "latin": {"m": ["n", "s", "rd", "k"], "f": ["lia", "na", "ra", "lle"], "n": ["r", "l"], "surname": ["nd", "rt", "ll", "ck"]},
    "cyrillic": {"m": ["н", "р", "й"], "f": ["на", "ля", "ра"], "n": ["н"], "surname": ["нко", "рук", "лик"]},
    "greek": {"m": ["ρης", "νος", "λης"], "f": ["νη", "ρία", "λα"], "n": ["ν"], "surname": ["δης", "κης", "πας"]},
}



def _any_of(words: Iterable[str]) -> str:
    """A pattern for any of the words, which share their beginnings: no word is tried letter by letter on its own."""
    heads: dict[str, set[str]] = {}
    for w in words:
        heads.setdefault(w[:1], set()).add(w[1:])
    ends = "" in heads
    heads.pop("", None)
    parts = [re.escape(h) + _any_of(rest) for h, rest in sorted(heads.items())]
    if not parts:
        return ""
    return f"(?:{'|'.join(parts)})" + ("?" if ends else "") if len(parts) > 1 or ends else parts[0]


def _cased(words: Iterable[str]) -> list[str]:
    return [v for w in words for v in (w, w.upper())]


#: A word of a name: hyphens and apostrophes join parts, a possessive s is none of it. An initial stands as it is.
_WORD = r"(?=\p{Lu}[\p{L}'’-]*\p{Ll})\p{Lu}\p{L}*(?:['’-]\p{L}{2,})*"
_CAPITALS = r"\p{Lu}{2,}(?:['’-]\p{Lu}{2,})*(?![\p{L}\p{N}])"
_INITIAL = r"\p{Lu}\."
_TITLE = _any_of(_cased(t for ts in TITLES.values() for t in ts))
_GIVEN = _any_of(t for ts in GIVEN.values() for t in ts)
_TITLE_CAPITALS = _any_of(t.upper() for ts in TITLES.values() for t in ts)
_GIVEN_CAPITALS = _any_of(t.upper() for ts in GIVEN.values() for t in ts)
_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

_YEAR = "(?:1[89]|20)[0-9]{2}"
_NO_TITLE = rf"(?!(?:{_TITLE})(?![\p{{L}}]))"
_TITLED = rf"(?:(?:{_TITLE})\.? ){{1,4}}(?:{_INITIAL} ?){{0,2}}{_NO_TITLE}{_WORD}(?: {_NO_TITLE}{_WORD}){{0,2}}"
_TITLED_CAPITALS = rf"(?:(?:{_TITLE_CAPITALS})\.? ){{1,4}}(?:{_INITIAL} ?){{0,2}}{_NO_TITLE}{_CAPITALS}(?: {_NO_TITLE}{_CAPITALS}){{0,2}}"

#: Kinds in the order in which they are tried, with the pattern that finds them.
KINDS = {
    "email": r"(?<![A-Za-z0-9])(?=[A-Za-z0-9])(?:(?<![._%+-])|(?<=(?<![A-Za-z0-9._%+-])[._%+-]{1,8}))[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}",
    "key": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36,255}\b|\bsk-[A-Za-z0-9_-]{20,200}",
    "secret": r"(?<=[=:\"' \t])(?<=[=:][ \t]{0,3}[\"']?)(?<=(?:\b|_|(?<=[a-z])(?=[A-Z]))(?i:password|passwd|pwd|secret|token|api_key|apikey|api-key|access_key)[\"']?[ \t]{0,3}[=:][ \t]{0,3}[\"']?)[^\s\"',;<>]{6,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ipv6": rf"(?<![\w:])(?=[A-Fa-f:]{{0,34}}[0-9])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,7}}:(?:{_HEX}(?::{_HEX}){{0,5}})?|::{_HEX}(?::{_HEX}){{0,6}})(?![\w:]|\.[0-9])",
    "ipv4": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.[0-9])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "card": r"(?<![\w.+-])(?:4[0-9]{3}|5[1-5][0-9]{2}|2[2-7][0-9]{2}|6011|65[0-9]{2}|64[4-9][0-9]|35[2-8][0-9])(?:[ -]?[0-9]{4}){3}(?!\w)|(?<![\w.+-])3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5}(?!\w)",
    # with a country code, but no decimal number; an area in brackets; three, three and four digits; a leading 0; Spanish and French groups
    "phone": r"(?=[+(0-9])(?:"
    rf"(?<![\w+])\+(?![0-9]+\.[0-9]+(?![0-9.]))(?:[0-9]{{8,14}}(?!\w)|[0-9]{{1,3}}[ .-]?(?:\([0-9]{{2,4}}\) ?|[0-9]{{2,4}}[ .-])[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}(?!\w)|(?=(?:[ ./()-]{{0,3}}[0-9]){{8,15}}(?![0-9]))[0-9]{{1,3}}(?:[ ./-]{{0,2}}(?:\([0-9]{{1,4}}\)|[0-9]{{1,9}})){{1,7}}(?!\w))"
    rf"|(?<![\w+])(?!\({_YEAR}\) ?{_YEAR})\([0-9]{{2,4}}\) ?[0-9]{{3,4}}[ .-]?[0-9]{{3,4}}(?!\w)"
    r"|(?<![\w+.-])(?:1[ .-])?[2-9][0-9]{2}[ .-][0-9]{3}[ .-][0-9]{4}(?!\w|[.-][0-9])"
    r"|(?<![\w+.-])0[0-9]{1,4}(?<gap>[ -])[0-9]{3,4}\k<gap>?[0-9]{3,4}(?!\w|[.-][0-9])"
    r"|(?<![\w+.-])(?:0[1-9](?:[ .-][0-9]{2}){4}|[679][0-9]{2}(?:[ .-][0-9]{2}){3}|[679][0-9]{2}(?:[ -][0-9]{3}){2}|9[0-9][ .-][0-9]{3}(?:[ .-][0-9]{2}){2})(?!\w|[ .-][0-9]))",
    "name": rf"(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:{_TITLED}|(?:{_GIVEN}) (?:{_INITIAL} )?{_WORD}|{_TITLED_CAPITALS}|(?:{_GIVEN_CAPITALS}) (?:{_INITIAL} )?{_CAPITALS})",
}
ENTITY = "|".join(f"(?:{p})" for p in KINDS.values())
#: The same for texts without an @, in which no address can be found.
NO_AT = "|".join(f"(?:{p})" for k, p in KINDS.items() if k != "email")

#: What stands for a match while a text is taken apart: a code point that is no character.
MARK = "\uffff"
#: After so many attempts a surrogate may be longer than what it replaces.
ATTEMPTS = 12


def matches(text: Column) -> Column:
    """The personal data in a text, in order. Texts without a digit, an @ and any word of a name or secret are not searched."""
    gate = F.rlike(text, F.lit(rf"[0-9@]|(?i:password|passwd|pwd|secret|token|api|access_key)|(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:{_TITLE}|{_GIVEN}|{_GIVEN_CAPITALS})\.? "))
    found = lambda pattern: F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.when(text.isNotNull() & gate, F.when(F.contains(text, F.lit("@")), found(ENTITY)).otherwise(found(NO_AT))).otherwise(F.array().cast("array<string>"))


def kind_of(match: Column) -> Column:
    """The kind of a match; `none` for a number in the shape of a card or an IBAN whose checksum is wrong."""
    shape = F.lit("secret")
    for kind, pattern in reversed(list(KINDS.items())):
        if kind != "secret":
            shape = F.when(F.rlike(match, F.lit(f"^(?:{pattern})$")), F.lit(kind)).otherwise(shape)
    wrong = lambda k: F.when(k == "card", luhn(F.regexp_replace(match, "[^0-9]", "")) != 0).when(k == "iban", mod_97(F.regexp_replace(match, " ", "")) != 1).otherwise(F.lit(False))
    # a lambda's variable keeps the plan from holding the patterns once for every use
    return F.get(F.transform(F.array(shape), lambda k: F.when(wrong(k), F.lit("none")).otherwise(k)), F.lit(0))


def luhn(digits: Column) -> Column:
    """The checksum of a string of digits: 0 if it is right."""
    n = F.length(digits)
    doubled = F.transform(F.split(digits, ""), lambda c, i: F.when(F.pmod(n - i, F.lit(2)) == 0, F.pmod(c.cast("int") * 2, F.lit(10)) + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int")))
    return F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10))


def mod_97(iban: Column) -> Column:
    """The checksum of an IBAN without blanks, in capitals: 1 if it is right. Letters count 10 to 35, the first four signs last."""
    turned = F.concat(F.substring(iban, F.lit(5), F.length(iban)), F.substring(iban, 1, 4))
    value = lambda c: F.ascii(c) - F.when(F.rlike(c, F.lit("[A-Z]")), ord("A") - 10).otherwise(ord("0"))
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.pmod(a * F.when(F.rlike(c, F.lit("[A-Z]")), 100).otherwise(10) + value(c), F.lit(97)))


def _no_unit(word: Column) -> Column:
    """Titles and initials stay as they are."""
    return F.rlike(word, F.lit(rf"^(?:(?:{_TITLE})\.?|{_INITIAL})$"))


def units(match: Column, kind: Column) -> Column:
    """What of a match is replaced as one: (kind, norm, style).

    A name's words each stand alone, so that a word stays one word wherever it occurs; its style says how it stands
    here: m, f or n for a given name (by the list, else by the title), surname for the last. Of all else the norm has
    no case and, but for addresses and secrets, no punctuation; of a phone it is the last ten digits, so that a country
    code makes no other number.
    """
    words = F.flatten(F.transform(F.split(match, " "), lambda w: F.split(F.regexp_replace(w, rf"^({_INITIAL})(?=\p{{L}})", "$1 "), " ")))
    words = F.filter(words, lambda w: ~_no_unit(w))
    titled = lambda g: F.rlike(match, F.lit(rf"^(?:(?:{_TITLE})\.? ){{0,3}}(?:{_any_of(_cased(TITLES[g]))})\.? "))
    title = F.when(titled("f"), "f").when(titled("m"), "m").otherwise("n")
    listed = lambda w, g: F.rlike(w, F.lit(rf"^(?:{_any_of(_cased(GIVEN[g]))})$"))
    style = lambda w, i: F.when(listed(w, "f"), "f").when(listed(w, "m"), "m").when(i == F.size(words) - 1, "surname").otherwise(title)
    named = F.transform(words, lambda w, i: F.struct(F.lit("name").alias("kind"), F.lower(w).alias("norm"), style(w, i).alias("style")))
    bare = F.when(kind.isin("email", "secret", "key", "ipv6", "ipv4"), match).when(kind == "phone", F.substring(F.regexp_replace(match, "[^0-9]", ""), -10, 10)).otherwise(F.regexp_replace(match, "[^0-9A-Za-z]", ""))
    # case carries meaning in secrets and keys
    norm = F.when(kind.isin("secret", "key"), bare).otherwise(F.lower(bare))
    return F.when(kind == "name", named).when(kind == "none", F.slice(named, 1, 0)).otherwise(F.array(F.struct(kind.alias("kind"), norm.alias("norm"), F.lit("").alias("style"))))


def _number(digest: Column, i: Column) -> Column:
    return F.conv(F.substring(digest, F.pmod(i * 4, F.lit(248)) + 1, F.lit(4)), 16, 10).cast("int")


def _of(digest: Column, i: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), F.pmod(_number(digest, i), F.lit(len(values))) + 1)


def _scrambled(kind: Column, norm: Column, digest: Column) -> Column:
    """norm with another digit for each digit and another letter of its script and case for each letter."""
    size, number = F.length(norm), lambda i: _number(digest, i)
    hexadecimal = F.rlike(norm, F.lit("^[0-9a-f]+$|^[0-9A-F]+$")) | (kind == "ipv6")
    stays = F.when(kind == "email", F.length(F.substring_index(norm, ".", -1))).otherwise(0)  # the last label, from the end
    leads = F.when(kind == "key", F.when(F.rlike(norm, F.lit("^(?:AKIA|ASIA|gh.[_])")), 4).otherwise(3)).when(kind == "iban", 2).when(kind == "card", 1).otherwise(0)
    letters = lambda i, first: F.char(F.lit(ord(first)) + F.pmod(number(i), F.when(hexadecimal, 6).otherwise(26)))

    def one(c: Column, i: Column) -> Column:
        fresh = (
            F.when(F.rlike(c, F.lit("[0-9]")), F.pmod(number(i), F.lit(10)).cast("string")).when(F.rlike(c, F.lit("[a-z]")), letters(i, "a")).when(F.rlike(c, F.lit("[A-Z]")), letters(i, "A")).when(F.rlike(c, F.lit("[\\x00-\\x7F]")), c)
            .when(F.rlike(c, F.lit(r"(?=\p{IsCyrillic})\p{Lu}")), _of(digest, i, "БВГДЖЗИКЛМНПРСТУ")).when(F.rlike(c, F.lit(r"\p{IsCyrillic}")), _of(digest, i, "бвгджзиклмнпрсту"))
            .when(F.rlike(c, F.lit(r"(?=\p{IsGreek})\p{Lu}")), _of(digest, i, "ΑΒΓΔΕΖΗΘΚΛΜΝΞΠΡΣ")).when(F.rlike(c, F.lit(r"\p{IsGreek}")), _of(digest, i, "αβγδεζηθκλμνξπρσ"))
            .when(F.rlike(c, F.lit(r"\p{Lu}")), letters(i, "A")).when(F.rlike(c, F.lit(r"\p{L}")), letters(i, "a")).when(F.rlike(c, F.lit(r"\p{N}")), F.pmod(number(i), F.lit(10)).cast("string")).otherwise(c)
        )
        return F.when((i < leads) | (i >= size - stays), c).otherwise(fresh)

    return F.array_join(F.transform(F.split(norm, ""), one), "")


def surrogates(open_: DataFrame, attempt: int, key: str) -> DataFrame:
    """(kind, norm, style, seed) with a keyed `surrogate` of the same kind, script, gender and format: digits for digits,
    letters for letters. seed is a digest of kind and norm. Every step is a column of its own, used by the next."""
    kind, norm, style, digest, plain = (F.col(c) for c in ("kind", "norm", "style", "digest", "plain"))
    seeded = F.concat_ws("|", F.lit(key), "seed", F.lit(str(attempt)))
    rows = open_.withColumn("digest", F.concat(F.sha2(seeded, 512), F.sha2(F.concat(seeded, F.lit("|2")), 512)))
    rows = rows.withColumn("plain", F.when(kind.isin("name", "ipv4"), F.lit("")).otherwise(_scrambled(kind, norm, digest)))
    number = lambda i: _number(digest, i)
    # the last digit of a card and the check digits of an IBAN make the checksum right
    digits = F.regexp_replace(F.substring(plain, F.lit(1), F.length(norm) - 1), "[^0-9]", "0")
    card = F.concat(digits, F.pmod(F.lit(10) - luhn(F.concat(digits, F.lit("0"))), F.lit(10)).cast("string"))
    country, account = F.substring(norm, 1, 2), F.substring(plain, F.lit(5), F.length(norm))
    check = F.lpad((F.lit(98) - mod_97(F.upper(F.concat(country, F.lit("00"), account)))).cast("string"), 2, "0")
    octets = F.array_join(F.transform(F.split(norm, r"\."), lambda o, i: F.when(F.length(o) == 3, F.lit(100) + F.pmod(number(i), F.lit(124))).when(F.length(o) == 2, F.lit(10) + F.pmod(number(i), F.lit(90))).otherwise(1 + F.pmod(number(i), F.lit(9))).cast("string")), ".")
    script = F.when(F.rlike(norm, F.lit(r"\p{IsCyrillic}")), F.lit("cyrillic")).when(F.rlike(norm, F.lit(r"\p{IsGreek}")), F.lit("greek")).otherwise(F.lit("latin"))

    def made(of_script: str) -> Column:
        ending = F.lit("")
        for g, values in ENDINGS[of_script].items():
            ending = F.when(style == g, _of(digest, F.lit(40), values)).otherwise(ending)
        # more syllables with every attempt that collided
        return F.concat(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2 + attempt)), lambda i: _of(digest, i, SYLLABLES[of_script])), ""), ending)

    name = F.when(script == "cyrillic", made("cyrillic")).when(script == "greek", made("greek")).otherwise(made("latin"))
    if attempt < ATTEMPTS:
        found = F.when(kind == "ipv4", octets).when(kind == "card", card).when(kind == "iban", F.concat(country, check, account)).otherwise(plain)
    else:
        longer = F.when(kind.isin("card", "phone", "ssn"), F.pmod(number(F.lit(50)), F.lit(10_000)).cast("string")).when(kind == "ipv6", F.concat(F.when(F.endswith(norm, F.lit(":")), "").otherwise(":"), F.substring(digest, 200, 4))).otherwise(F.substring(digest, 200, 6))
        body = F.when(kind == "ipv4", octets).otherwise(plain)
        found = F.when(kind == "email", F.concat(longer, body)).otherwise(F.concat(body, longer))
    return rows.withColumn("surrogate", F.when(kind == "name", name).otherwise(found)).drop("digest", "plain")


def dictionary(found: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) from (kind, norm, style), one row for each kind and norm: no two norms of a kind share a surrogate, and none is a norm.

    Every norm gets its keyed surrogate; of those that meet, the smallest norm keeps it and the others try again, as
    do those that hit a norm of the corpus or a surrogate that is taken. Rounds go on until none is left.
    """
    norms = stage(found.withColumn("seed", F.sha2(F.concat_ws("|", "kind", "norm"), 512)), "pii-norms")
    open_, done, attempt = norms, None, 0
    while True:
        tried = surrogates(open_, attempt, key)
        real = tried.join(norms.select("kind", F.col("norm").alias("surrogate")), ["kind", "surrogate"], "left_anti")
        first = real.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm"))
        if done is not None:
            first = first.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = stage(first.select("kind", "norm", "surrogate"), "pii-surrogates")
        done = won if done is None else done.unionByName(won)
        open_ = stage(open_.join(won, ["kind", "norm"], "left_anti"), "pii-open")
        if open_.isEmpty():
            drop(norms, open_)
            return done
        attempt += 1


def lay(match: Column, kind: Column, replacement: Column) -> Column:
    """The surrogate in the shape of the match: its punctuation, and upper case where it has some; a phone's country code stays."""
    whole = kind.isin("email", "secret", "key", "ipv6", "ipv4")
    slot = F.when(whole, F.lit("(?s).")).otherwise(F.lit("[0-9A-Za-z]"))
    chars, slots = F.split(match, ""), F.regexp_count(match, slot)
    shift = F.greatest(F.length(replacement) - slots, F.lit(0))  # only after many attempts
    ahead = F.greatest(slots - F.length(replacement), F.lit(0))  # only of phones
    start = F.when(kind == "email", shift).otherwise(F.lit(0))

    def one(c: Column, i: Column) -> Column:
        place = F.when(whole, i).otherwise(F.regexp_count(F.substring(match, F.lit(1), i), slot)) - ahead
        s = F.substring(replacement, start + place + 1, F.lit(1))
        return F.when(~F.rlike(c, slot) | (place < 0), c).when(F.rlike(c, F.lit("[A-Z]")), F.upper(s)).otherwise(s)

    body = F.array_join(F.transform(chars, one), "")
    return F.when(kind == "email", F.concat(F.substring(replacement, F.lit(1), shift), body)).otherwise(F.concat(body, F.substring(replacement, F.length(replacement) - shift + 1, shift)))


def style_of(styles: Column) -> Column:
    """One style for a word from those of all its places: a given name if it ever is one, of both genders or none neutral."""
    has = lambda s: F.array_contains(styles, s)
    return F.when(has("m") & ~has("f"), "m").when(has("f") & ~has("m"), "f").when(has("n") | has("m") | has("f"), "n").when(has("surname"), "surname").otherwise("")


def replace(docs: DataFrame, *, text: str = "text", key: str = "surrogates", count: str | None = None) -> DataFrame:
    """docs with every detected piece of personal data replaced in `text`; all other columns as they are.

    Replacements are keyed, of the same kind, script, gender and format; equal entities get equal surrogates in all
    documents (case and punctuation don't count), different ones different surrogates. Every text is searched once,
    and written with what was found; only documents with personal data travel. Their distinct entities form a
    dictionary, which is joined back entity by entity.

    With `count`, a column of that name says how many matches were replaced. Every row comes out, whatever was found
    in it: null and empty texts stay as they are, repeated rows are all rewritten alike, a text may be as long as a row
    can be, columns may have any names, an empty table gives an empty result.
    """
    names = docs.columns
    told = F.transform(matches(F.col("row").getField(text)), lambda m: F.struct(m.alias("match"), kind_of(m).alias("kind")))
    rows = docs.select(*whole_row(names)).withColumn("found", F.transform(told, lambda f: F.struct(f["match"].alias("match"), f["kind"].alias("kind"), units(f["match"], f["kind"]).alias("units"))))
    searched = stage(rows.withColumn("at", F.monotonically_increasing_id()), "pii-found")
    private = F.size(F.filter("found", lambda f: f["kind"] != "none"))
    clean = searched.filter(private == 0).select(*unpacked(names), *([F.lit(0).alias(count)] if count else []))
    dirty = searched.filter(private > 0)
    used = stage(dirty.select("at", F.explode(F.array_distinct(F.flatten(F.col("found.units")))).alias("unit")).select("at", "unit.kind", "unit.norm", "unit.style"), "pii-units")
    known = dictionary(used.groupBy("kind", "norm").agg(style_of(F.collect_set("style")).alias("style")), key)
    entry = F.struct(F.struct("kind", "norm").alias("k"), F.col("surrogate").alias("v"))
    pairs = used.select("at", "kind", "norm").distinct().join(known, ["kind", "norm"]).groupBy("at").agg(F.map_from_entries(F.collect_list(entry)).alias("map"))
    joined = dirty.join(pairs, "at", "left")  # left: whatever is found, no row goes

    def value(kind: Column, norm: Column, otherwise: Column) -> Column:
        return F.coalesce(F.element_at(F.col("map"), F.struct(kind.alias("kind"), norm.alias("norm"))), otherwise)

    def named(match: Column) -> Column:
        cased = lambda w, s: F.when(F.rlike(w, F.lit(r"^[\p{Lu}'’-]+$")) & (F.length(w) > 1), F.upper(s)).otherwise(F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, F.lit(2), F.length(s))))
        word = lambda w: F.when(_no_unit(w), w).otherwise(cased(w, value(F.lit("name"), F.lower(w), w)))
        initial = rf"^({_INITIAL})(?=\p{{L}})"
        return F.array_join(F.transform(F.split(match, " "), lambda w: F.when(F.rlike(w, F.lit(initial)), F.concat(F.regexp_extract(w, initial, 1), word(F.regexp_replace(w, initial, "")))).otherwise(word(w))), " ")

    def laid(f: Column) -> Column:
        unit = F.get(f["units"], F.lit(0))
        return lay(f["match"], f["kind"], value(unit["kind"], unit["norm"], unit["norm"]))

    fresh = F.transform("found", lambda f: F.when(f["kind"] == "none", f["match"]).when(f["kind"] == "name", named(f["match"])).otherwise(laid(f)))
    whole = F.col("row").getField(text)
    # split() would compile the long pattern again for every row; a text that holds the mark itself takes that way
    gaps = F.when(F.contains(whole, F.lit(MARK)), F.split(whole, ENTITY, -1)).otherwise(F.split(F.when(F.contains(whole, F.lit("@")), F.regexp_replace(whole, ENTITY, MARK)).otherwise(F.regexp_replace(whole, NO_AT, MARK)), MARK, -1))
    rewritten = F.array_join(F.zip_with(gaps, fresh, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")
    changed = joined.select("row", rewritten.alias("_text"), private.alias("_n")).select(*[F.col("_text").alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names], *([F.col("_n").alias(count)] if count else []))
    return clean.unionByName(changed)


def op7_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace(docs, count="n_replaced")
