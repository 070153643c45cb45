"""Text cleaning as JVM-side column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

_UNCASED_RUN = r"([^\p{Lu}\p{Ll}\p{Lt}]+)"
_BREAK = "\x00 "
# Printable ASCII in which a blank stands between other characters and the next letter: words begin at blanks only.
_PLAIN = r"^[A-Za-z ]*+(?:[!-@\[-`{-~]++(?: [A-Za-z ]*+)?+)*+\z"
# The same with no blank at either end.
_PLAIN_STRIPPED = r"^(?! )[A-Za-z ]*+(?:[!-@\[-`{-~]++(?: [A-Za-z ]*+)?+)*+(?<! )\z"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def title_case(text: Column) -> Column:
    """Capitalise after every uncased character ("lady's" -> "Lady'S").

    initcap starts words at blanks only, so each uncased run gets a marked blank behind it
    first, which is taken out again afterwards. Plain texts need none.
    """
    broken = F.regexp_replace(text, _UNCASED_RUN, f"$1{_BREAK}")
    return F.when(text.rlike(_PLAIN), F.initcap(text)).otherwise(F.replace(F.initcap(broken), F.lit(_BREAK), F.lit("")))


def clean_text(text: Column) -> Column:
    return F.when(text.rlike(_PLAIN_STRIPPED), F.initcap(text)).otherwise(title_case(strip(text)))


def base_name(text: Column) -> Column:
    """The name before its first bracket: "Paddy(Dhan)(Common)" -> "Paddy"."""
    return clean_text(F.substring_index(text, "(", 1))
