"""Column functions over paths and text.  All of them run inside the JVM."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space characters that trimming removes.
WHITE_SPACE = (
    "\t\n\v\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Extensions indexed when the caller names none.
DEFAULT_EXTENSIONS = (
    ".go", ".py", ".md", ".mdx", ".ts", ".tsx", ".js", ".jsx", ".rs", ".java", ".cpp", ".c", ".h",
)

# Language of each extension; anything else is "text".
LANGUAGES = {
    "go": (".go",),
    "python": (".py",),
    "markdown": (".md", ".mdx"),
    "typescript": (".ts", ".tsx"),
    "javascript": (".js", ".jsx"),
    "rust": (".rs",),
    "java": (".java",),
    "cpp": (".cpp", ".cc", ".cxx"),
    "c": (".c", ".h", ".hpp"),
}


def trim_space(text: Column) -> Column:
    """Trim Unicode white space.  Works on the raw bytes, so invalid UTF-8 survives."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return trim_space(text) == ""


def hash_content(content: Column) -> Column:
    """SHA-256 in lower-case hex; equal for a binary column and its cast to string."""
    return F.sha2(content, 256)


def record_id(workspace_id: Column, path: Column) -> Column:
    return F.sha2(F.concat(workspace_id, F.lit(":"), path), 256)


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot, or '' for a name without one."""
    name = F.substring_index(path, "/", -1)
    return F.when(
        name.contains("."), F.lower(F.concat(F.lit("."), F.substring_index(name, ".", -1)))
    ).otherwise("")


def language_of(path: Column) -> Column:
    ext = extension(path)
    tag = F.lit("text")
    for name, exts in LANGUAGES.items():
        tag = F.when(ext.isin(*exts), name).otherwise(tag)
    return tag


def allowed(path: Column, extensions=DEFAULT_EXTENSIONS) -> Column:
    return extension(path).isin(*[e.lower() for e in extensions])


def in_hidden_dir(path: Column) -> Column:
    """True when a directory below the root starts with a dot; hidden *files* are visible."""
    return F.concat(F.lit("/"), path).rlike(r"/\.[^/]+/")


def relative_key(key: Column, prefix: Column) -> Column:
    """Object key without ``prefix`` and without one following slash.

    A prefix is plain text, not a directory: ``src`` turns ``src2/x.go`` into ``2/x.go``.
    """
    rest = F.when(F.startswith(key, prefix), F.substr(key, F.length(prefix) + 1)).otherwise(key)
    return F.when(F.startswith(rest, F.lit("/")), F.substr(rest, F.lit(2))).otherwise(rest)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row.

    An expensive column used inside a lambda would otherwise be inlined there by the
    optimizer and evaluated once per array element.
    """
    return F.transform(F.array(value), body)[0]


def is_delete(action: Column) -> Column:
    """Only the action ``delete`` deletes; every other one, and a missing one, is an upsert."""
    return action.eqNullSafe("delete")


def metadata_json(metadata: Column) -> Column:
    """Metadata as JSON with sorted keys; a missing map is ``{}``."""
    return F.coalesce(
        F.to_json(F.map_from_entries(F.array_sort(F.map_entries(metadata)))), F.lit("{}")
    )


def by_bytes(content: Column, chunker: Callable) -> Column:
    """Run a text chunker so that bytes which are not UTF-8 come out unchanged.

    Regular expressions replace invalid bytes.  Such a file is read as ISO-8859-1, where
    every byte is one character, and each piece is turned back before it is trimmed.
    """

    def with_flag(valid, text):
        view = F.when(valid, text).otherwise(F.decode(text.cast("binary"), "ISO-8859-1"))

        def original(piece):
            return F.when(valid, piece).otherwise(
                F.encode(piece, "ISO-8859-1").cast("string")
            )

        return let(view, lambda t: chunker(t, original))

    return let(
        content, lambda text: let(F.is_valid_utf8(text), lambda valid: with_flag(valid, text))
    )
