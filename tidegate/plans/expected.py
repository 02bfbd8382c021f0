"""What the oracles hold the engine against, written out on their own."""

# Spellings that mean "no value" in a CSV field.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Fixed value: texts that Python's float() accepts, without blanks.
VOTE_PATTERN = r"^[+-]?(([0-9]+(_[0-9]+)*\.?([0-9]+(_[0-9]+)*)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+(_[0-9]+)*)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])$"
