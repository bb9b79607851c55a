from pyspark.sql import Column, functions as F

MASK = "***"


def mask_name(name: Column) -> Column:
    """First character plus a mask; NULL and '' pass through."""
    return F.when(F.length(name) == 0, F.lit("")).when(
        name.isNotNull(), F.concat(F.substring(name, 1, 1), F.lit(MASK)))


def mask_id(ident: Column) -> Column:
    """Two leading and two trailing characters; ids of four or fewer vanish."""
    return F.when(F.length(ident) <= 4, F.lit(MASK)).when(
        ident.isNotNull(),
        F.concat(F.substring(ident, 1, 2), F.lit(MASK), F.right(ident, F.lit(2))))


def mask_email(mail: Column) -> Column:
    at = F.instr(mail, "@")
    kept = F.concat(F.substring(mail, 1, 1), F.lit(MASK), F.substr(mail, at))
    return F.when(at == 0, F.lit(MASK)).when(mail.isNotNull(), kept)


def mask_phone(phone: Column) -> Column:
    digits = F.regexp_replace(phone, "[^0-9]", "")
    return F.when(phone.isNotNull(), F.concat(F.lit("***-***-"), F.right(digits, F.lit(4))))
