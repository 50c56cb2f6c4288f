"""The registered queries of this package and their SQL."""

from gaugeline.llm import chunking, decontamination, language, language_model, mixing, negatives, phrases, quality, sharding, simhash, suffixes, urls, warc

QUERIES = {
    q.__name__: q
    for q in (
        language.op1_language,
        simhash.op2_simhash,
        urls.op3_url_filters,
        decontamination.op4_decontamination,
        chunking.op5_fingerprints,
        suffixes.op6_suffixes,
        language_model.op7_language_model,
        mixing.op8_source_mix,
        warc.op9_warc,
        sharding.op10_shards,
        negatives.op11_hard_negatives,
        quality.op12_quality,
        phrases.op13_collocations,
    )
}
ORACLES = {
    "op3_url_filters": urls.SQL,
    "op6_suffixes": suffixes.SQL,
    "op9_warc": warc.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op13_collocations": phrases.SQL,
}
