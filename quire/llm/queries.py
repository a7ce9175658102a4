"""Queries of the ten problems, and the SQL of those that SQL can express over whole tables."""

from __future__ import annotations

from quire.llm import bpe, budget, content, forms, leaks, pieces, quality, scan, splits, tongues

QUERIES = {
    "p1_found": scan.p1_found,
    "p1_text": scan.p1_text,
    "p2_found": tongues.p2_found,
    "p2_books": tongues.p2_books,
    "p2_segments": tongues.p2_segments,
    "p3_found": forms.p3_found,
    "p3_forms": forms.p3_forms,
    "p3_classes": forms.p3_classes,
    "p4_tokens": budget.p4_tokens,
    "p5_found": pieces.p5_found,
    "p5_pieces": pieces.p5_pieces,
    "p6_found": quality.p6_found,
    "p6_books": quality.p6_books,
    "p6_documents": quality.p6_documents,
    "p7_found": splits.p7_found,
    "p7_split": splits.p7_split,
    "p8_ids": bpe.p8_ids,
    "p9_found": leaks.p9_found,
    "p9_spans": leaks.p9_spans,
    "p10_found": content.p10_found,
    "p10_scores": content.p10_scores,
    "p10_rates": content.p10_rates,
}
SQL = {
    "p5_found": "select distinct book_id, position from sentences where book_id is not null and position is not null and length(text) > 2000",
}
