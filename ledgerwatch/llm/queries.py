"""The queries of this package by name, and SQL for those that a second engine can run."""

from ledgerwatch.llm import binary, chat, jaccard, language, lexical, lexicon, maxent, packing, quality, repair, topk, warc, wrapper

QUERIES = {
    f.__name__: f
    for f in (
        wrapper.op1_wrapper_text,
        quality.op2_quality_rules,
        topk.op3_exact_top_k,
        packing.op4_best_fit_packing,
        jaccard.op5_jaccard_join,
        chat.op6_chat_format,
        language.op7_language_id,
        lexicon.op8_bpe_lexicon,
        maxent.op9_maxent_scores,
        binary.op10_token_files,
        warc.op11_warc_archives,
        repair.op12_structure_repair,
        lexical.op13_lexical_search,
    )
}
ORACLES: dict[str, str] = {"op3_exact_top_k": topk.ORACLE, "op6_chat_format": chat.ORACLE, "op11_warc_archives": warc.ORACLE, "op12_structure_repair": repair.ORACLE, "op13_lexical_search": lexical.ORACLE}
