"""Text that goes into SQL statements."""


def string_literal(text: str) -> str:
    """SQL string literal; backslash and single quote are escaped."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(name: str) -> str:
    """One name in backticks, dots and all."""
    return "`" + name.replace("`", "``") + "`"


def identifier(name: str) -> str:
    """Possibly qualified name: ``a.b`` gives ```a`.`b```. Parts that are already quoted stay
    as they are."""
    return ".".join(p if p.startswith("`") else quoted(p) for p in name.split("."))
