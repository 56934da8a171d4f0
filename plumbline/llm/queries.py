"""Registered queries of this package and the SQL that states the results of those that SQL can express."""

from plumbline.llm import (byte_bpe, fm_dedup, gray_simhash, hard_negatives, kneser_ney, language_crf, main_text,
                           noisy_toxicity, packing, pairwise_quality, prefix_forest, tile_topk, token_alignment)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_prefix_forest": prefix_forest.op2_prefix_forest,
    "op3_language_crf": language_crf.op3_language_crf,
    "op4_byte_bpe": byte_bpe.op4_byte_bpe,
    "op5_fm_dedup": fm_dedup.op5_fm_dedup,
    "op6_gray_simhash": gray_simhash.op6_gray_simhash,
    "op7_pairwise_quality": pairwise_quality.op7_pairwise_quality,
    "op8_tile_topk": tile_topk.op8_tile_topk,
    "op9_kneser_ney": kneser_ney.op9_kneser_ney,
    "op10_noisy_toxicity": noisy_toxicity.op10_noisy_toxicity,
    "op11_segment_negatives": hard_negatives.op11_segment_negatives,
    "op12_text_alignment": token_alignment.op12_text_alignment,
    "op13_tag_ratio": main_text.op13_tag_ratio,
}
ORACLES = {
    "op5_fm_dedup": fm_dedup.OP5_SQL, "op8_tile_topk": tile_topk.OP8_SQL,
    "op11_segment_negatives": hard_negatives.OP11_SQL,
}
