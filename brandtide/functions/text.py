"""Text functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that product titles share whatever the brand, for the filtered vocabulary.
VOCABULARY_STOPWORDS = (
    "murah promo gratis ongkir terlaris premium asli murni original official resmi ready stock eceran paket bundle custom merk brand "
    "gram kilo liter ml sachet kemasan botol kaleng bungkus pcs pack dus karton halal bpom sertifikat certified collagen kolagen beans bean "
    "instan instant powder bubuk cair spray dried grade pria wanita dewasa anak manis pahit rasa aroma wangi"
).split()
# Words left out of the simple n-grams.
TITLE_STOPWORDS = (
    "kopi susu roast beans premium blend bubuk biji espresso robusta arabica arabika murah asli pria dewasa stamina gula aren cair liter house "
    "tanpa ampas pahit promo sale diskon 1kg kg gram gr kilo kemasan box sachet isi bpom halal super kualitas excellent minuman rasa diet "
    "khas nusantara original ori by for and dan"
).split()
# Words that describe a product on a page and name no brand.
GENERIC_WORDS = (
    "fashion summer winter autumn spring push up pushup comfort comfortable simple breathable premium new best original ori promo sale diskon "
    "murah bagus wanita pria cowok cewek bra bh shirt tshirt kaos hoodie pants celana sepatu tas anak dewasa small large big mini maxi "
    "light soft thin busa tipis korean style modern casual"
).split()


def clean_title(c: Column) -> Column:
    """Lower case, anything but a-z, 0-9 and white space a blank, blanks collapsed; null is empty."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^a-z0-9\s]", " "), r"\s+", " "))


def clean_spaces(c: Column) -> Column:
    """White space of any script collapsed and stripped; case and punctuation stay."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def normalized(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(clean_spaces(c)), r"[^a-z0-9&\-.\s]", " "), r"\s+", " "))


def skeleton(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def title_case(c: Column) -> Column:
    """The first letter of every run of letters upper, the rest lower: ``1001abc`` is ``1001Abc``."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substr(x, F.lit(2))))), "")


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def title_tokens(c: Column) -> Column:
    """Tokens of a clean title that may name a brand."""
    return F.filter(tokens(c), lambda w: ~w.isin(*TITLE_STOPWORDS) & (F.length(w) > 2) & ~w.rlike("^[0-9]+$"))


def vocabulary_tokens(c: Column) -> Column:
    return F.filter(tokens(c), lambda w: w.rlike("^[a-z]{3,}$") & ~w.isin(*VOCABULARY_STOPWORDS))


def once(c: Column, f) -> Column:
    """f(c) for a function that names its argument several times: the bound variable keeps c from being evaluated each time."""
    return F.element_at(F.transform(F.array(c), f), 1)


def ngrams(words: Column) -> Column:
    """Single words and neighbouring pairs of an array, in that order."""

    def both(w: Column) -> Column:
        rest = F.greatest(F.size(w) - 1, F.lit(0))
        return F.concat(w, F.zip_with(F.slice(w, F.lit(1), rest), F.slice(w, F.lit(2), rest), lambda a, b: F.concat_ws(" ", a, b)))

    return once(words, both)


def is_generic(normal: Column) -> Column:
    """Whether at least 60 % of a normalized name's words (one at least) are generic; true for an empty name."""

    def mostly(words: Column) -> Column:
        hits = F.size(F.filter(words, lambda w: w.isin(*GENERIC_WORDS)))
        return (F.size(words) == 0) | (hits >= F.greatest(F.lit(1), F.ceil(F.size(words) * 0.6)))

    return once(tokens(normal), mostly)


def substrings(c: Column) -> Column:
    """All distinct substrings of a name, the empty one among them."""

    def parts(x: Column) -> Column:
        from_each = F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.transform(F.sequence(F.lit(1), F.length(x) - i + 1), lambda n: F.substr(x, i, n)))
        return F.when(F.length(x) > 0, F.array_distinct(F.concat(F.array(F.lit("")), F.flatten(from_each)))).otherwise(F.array(F.lit("")))

    return once(c, parts)


# Fixed value: the sentence that gives a bare name a context before it is encoded.
SENTENCE = "produk dengan merek {}"


def sentence(name: Column, template: str = SENTENCE) -> Column:
    """A name within the sentence that an encoder is given; ``{}`` stands for the name."""
    before, _, after = template.partition("{}")
    return F.concat(F.lit(before), name, F.lit(after))


def json_list(names: Column) -> Column:
    """An array of names as the JSON text that a judge's prompt holds; letters of any script stay as they are."""
    return F.to_json(names)


def json_names(raw: Column) -> Column:
    """The array of strings in a model's answer: as it is, without a code fence, within prose, or cut short."""
    bare = F.trim(F.regexp_replace(raw, r"(?s)^\s*```[a-zA-Z]*\s*|\s*```\s*$", ""))
    parse = lambda x: F.from_json(x, "array<string>")
    inner = F.regexp_extract(bare, r"(?s)(\[.*\])", 1)
    start = F.substring_index(bare, "[", -1)
    cut = F.concat(F.lit("["), F.regexp_extract(start, r'(?s)^(.*")', 1), F.lit("]"))
    whole = F.concat(F.lit("["), F.regexp_extract(start, r'(?s)^(.*"),', 1), F.lit("]"))
    return F.coalesce(parse(bare), parse(F.when(inner != "", inner)), F.filter(parse(whole), lambda x: x.isNotNull()), parse(cut))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, z: s + z)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))
