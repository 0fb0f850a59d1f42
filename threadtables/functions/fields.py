"""Field lists and labels."""

# Content keys of review prose, in output order.
REVIEW_TEXT_FIELDS = [
    "summary",
    "strengths",
    "weaknesses",
    "questions",
    "details_of_ethics_concerns",
    "claims_and_evidence",
    "methods_and_evaluation_criteria",
    "theoretical_claims",
    "experimental_designs_or_analyses",
    "relation_to_broader_scientific_literature",
    "essential_references_not_discussed",
    "other_strengths_and_weaknesses",
    "other_comments_or_suggestions",
    "questions_for_authors",
    "review",
    "comments",
]

# Content keys of meta-review prose, in output order.
META_TEXT_FIELDS = [
    "summary",
    "reviewer_concerns",
    "reviewer_scores",
    "metareview",
    "justification_for_why_not_higher_score",
    "justification_for_why_not_lower_score",
]

# Content keys of author replies, in output order.
REPLY_TEXT_FIELDS = ["comment", "rebuttal", "response"]

# Review keys that are neither prose nor ratings.
HOUSEKEEPING_FIELDS = ["code_of_conduct", "supplementary_material", "flag_for_ethics_review"]

# Rating columns used when no review shows which ones a venue has.
DEFAULT_RATING_FIELDS = ["soundness", "presentation", "contribution", "rating", "confidence"]

# Profile link keys and how they are shown, in output order.
LINK_LABELS = {
    "homepage": "Homepage",
    "gscholar": "Google Scholar",
    "dblp": "DBLP",
    "semanticScholar": "Semantic Scholar",
    "orcid": "ORCID",
    "linkedin": "LinkedIn",
    "wikipedia": "Wikipedia",
    "aclanthology": "ACL Anthology",
}

# Separator between several replies in one cell, and between text blocks.
REPLY_SEPARATOR = "\n\n---\n\n"
BLOCK_SEPARATOR = "\n\n"


def label(field: str) -> str:
    """Shown form of a content key: underscores to blanks, title case."""
    return field.replace("_", " ").title()


def rating_labels(rating_fields: list[str]) -> dict[str, str]:
    """Field -> label; two fields with one label would share a column, so that is an error."""
    labels = {f: label(f) for f in rating_fields}
    if len(set(labels.values())) < len(labels):
        raise ValueError(f"rating fields share a column label: {sorted(rating_fields)}")
    return labels
