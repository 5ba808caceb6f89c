"""The conversion plans: raw wiki markup to clean Markdown, page by page.

Every step is a Column expression, so `preprocess`, `postprocess` and the
Markdown steps are one narrow stage each; only table-driven template expansion
moves data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dims import ListedPolicy, TagPolicy, TemplatePolicy
from ..functions.links import (
    drop_switches,
    external_to_text,
    nfkc_list,
    raw_categories,
    resolve_links,
)
from ..functions.markdown import CLEANUPS, blocks_to_markdown, is_corrupt
from ..functions.sections import drop_sections, finish, join_flat, join_sections, level2
from ..functions.tags import (
    apply_markup_policy,
    apply_tag_policy,
    hide_opaque,
    show_opaque,
    unsupported_tag_names,
)
from ..functions.templates import (
    apply_template_policy,
    finish_description,
    magic_templates,
    mark_templates,
    marked_names,
    marked_short_description,
    unsupported_names,
)
from ..functions.text import built_once, guard, let, nfkc, settle
from ..operators.expand import expand_by_dictionary
from ..operators.policy import with_listed_names
from ..session import through_table


def counter(names: Column) -> Column:
    """Names counted inside the row, as map<string, bigint>; no shuffle.

    Counts are the distances between the starts of runs in the sorted names.
    """

    def runs(ns: Column) -> Column:
        changes = lambda n, i: (i == 0) | (F.get(ns, i - 1) != n)
        starts = F.filter(
            F.transform(ns, lambda n, i: F.when(changes(n, i), i)), lambda i: i.isNotNull()
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda s, j: F.struct(
                    F.get(ns, s), (F.coalesce(F.get(at, j + 1), F.size(ns)) - s).cast("long")
                ),
            ),
        )

    return F.map_from_entries(let(F.array_sort(names), runs))


# The long expressions, over the columns that the plans below pass on.


@built_once
def _hidden() -> Column:
    return hide_opaque(guard(F.col("wikitext")))


def _whole() -> Column:
    return drop_switches(magic_templates(resolve_links(F.col("pre_hidden"))))


@built_once
def _first_pass() -> Column:
    """Links, magic templates and switches; cut into sections before templates go."""
    return join_sections(level2(join_flat(_whole())))


@built_once
def _nameless() -> Column:
    """Whether a template of the whole page has no name, also one in a section that is not kept."""
    suspect = F.col("pre_hidden").rlike(r"\{\{(?:\||\}\})")
    return F.when(suspect, F.array_contains(marked_names(mark_templates(_whole())), "")).otherwise(False)


@built_once
def _marked() -> Column:
    return mark_templates(F.col("pre_first"))


@built_once
def _description() -> Column:
    return marked_short_description(F.col("pre_marked"))


@built_once
def _dropped_names(policy: TemplatePolicy | ListedPolicy) -> Column:
    return unsupported_names(F.col("pre_names"), policy)


@built_once
def _kept_templates(policy: TemplatePolicy | ListedPolicy) -> Column:
    return show_opaque(apply_template_policy(F.col("pre_first"), policy))


@built_once
def _kept_sections(text: str) -> Column:
    return join_sections(level2(drop_sections(hide_opaque(F.col(text)))))


@built_once
def _without_tags(styled: bool) -> Column:
    policy = TagPolicy(styled=styled)
    return apply_markup_policy(apply_tag_policy(F.col("post_cut"), policy), policy)


@built_once
def _without_links() -> Column:
    text = external_to_text(resolve_links(F.col("post_tagged"), after_expansion=True))
    return finish(show_opaque(text))


@built_once
def _corrupt(text: str) -> Column:
    return is_corrupt(F.col(text))


@built_once
def _blocks(text: str) -> Column:
    return blocks_to_markdown(F.col(text))


@built_once
def _cleaned() -> Column:
    clean = F.col("md_blocks")
    for cleanup in CLEANUPS:
        clean = cleanup(clean)
    return clean


@built_once
def _counted(names: str) -> Column:
    return counter(F.col(names))


def preprocess(pages: DataFrame, policy: TemplatePolicy | DataFrame | None = None) -> DataFrame:
    """Adds the cleaned `wikitext`, raw categories, description and dropped templates.

    The columns arrive as `pre_*`; the input text stays as it was. A policy may be a table of names of
    any size; it is joined with the names on the pages.
    """
    out = pages.withColumn("pre_hidden", _hidden())
    out = out.withColumn("pre_nameless", _nameless())
    out = out.withColumn("pre_categories", raw_categories(F.col("pre_hidden")))
    out = settle(out, "pre_first", _first_pass())
    if isinstance(policy, DataFrame):
        out, policy = with_listed_names(out, policy, "pre_first", "pre_listed"), ListedPolicy("pre_listed")
    policy = policy or TemplatePolicy.default()
    out = out.withColumn("pre_marked", _marked())
    out = out.withColumn("pre_names", marked_names(F.col("pre_marked")))
    # Settled here, so that the raw text need not travel any further.
    error = F.when(F.col("wikitext").isNull(), "missing wikitext").when(
        F.col("pre_nameless") | F.array_contains("pre_names", ""), "empty template name"
    )
    return out.withColumns(
        {
            "pre_error": error,
            "pre_description": _description(),
            "pre_unsupported": _dropped_names(policy),
            "pre_wikitext": _kept_templates(policy),
        }
    ).drop("pre_hidden", "pre_first", "pre_marked", "pre_names", "pre_nameless", "pre_listed")


def postprocess(
    pages: DataFrame, text: str = "expanded", with_styling: bool = False
) -> DataFrame:
    """Adds `final_wikitext` and the names of unknown tags."""
    out = pages.withColumn("post_cut", _kept_sections(text))
    unknown = unsupported_tag_names(F.col("post_cut"), TagPolicy(styled=with_styling))
    out = out.withColumns({"post_unsupported": unknown, "post_tagged": _without_tags(with_styling)})
    return settle(out, "final_wikitext", _without_links()).drop("post_cut", "post_tagged")


def to_markdown(pages: DataFrame, text: str = "final_wikitext") -> DataFrame:
    """Adds `corrupt` and `markdown`, and normalises all text columns in one pass."""
    out = pages.withColumns({"corrupt": _corrupt(text), "md_blocks": _blocks(text)})
    # All four normalisations share one trip to Python.
    out = out.withColumns(
        {
            "md_blocks": nfkc(F.col("md_blocks")),
            "title": nfkc(F.col("title")),
            "categories": F.array_sort(nfkc_list(F.col("pre_categories"))),
            "description": nfkc(F.col("pre_description")),
        }
    )
    return out.withColumns(
        {"markdown": _cleaned(), "description": finish_description(F.col("description"))}
    )


def convert_pages(
    raw: DataFrame,
    expansions: DataFrame | None = None,
    with_styling: bool = False,
    policy: TemplatePolicy | DataFrame | None = None,
) -> DataFrame:
    """All pages with every derived column and a status: ok, corrupt or failed.

    `expansions(invocation, expansion)` replaces the remote expansion service;
    without it kept templates expand to nothing. Preprocessed pages are written once
    in front of the join with it.
    """
    pre = preprocess(raw, policy)
    expanded = expand_by_dictionary(pre, expansions, text="pre_wikitext", out="expanded")
    done = to_markdown(postprocess(expanded, with_styling=with_styling))
    status = (
        F.when(F.col("pre_error").isNotNull(), "failed")
        .when(F.col("corrupt"), "corrupt")
        .otherwise("ok")
    )
    return done.select(
        "pageid",
        "title",
        F.lit("en").alias("lang"),
        "revid",
        "categories",
        "description",
        F.col("wikitext").alias("raw_wikitext"),
        F.col("final_wikitext").alias("wikitext"),
        "markdown",
        _counted("post_unsupported").alias("unsupported_tags"),
        _counted("pre_unsupported").alias("unsupported_templates"),
        status.alias("status"),
        F.col("pre_error").alias("error"),
    )
