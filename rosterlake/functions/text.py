"""String cleaning."""

from pyspark.sql import functions as F

# A new word starts after white space and after these marks. The apostrophe is not one.
WORD_START = r"""(?U)(?<=[\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+\-])"""

# The characters of Unicode's White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trim_all(column):
    """Trim every kind of white space; the built-in `trim` takes blanks only."""
    return F.btrim(column, F.lit(WHITE_SPACE))


def title_case(column):
    """Upper-case the first letter of each word, lower-case the rest.

    The built-in `initcap` starts words at blanks only.
    """
    words = F.split(F.lower(column), WORD_START)
    capital = F.transform(
        words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    return F.array_join(capital, "")
