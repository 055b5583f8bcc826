"""Training-data operators: quality, packing, language, fingerprints, near-duplicates,
main text, sharding, byte-level BPE, licences, nearest neighbours, context-tree scores, filter
audit and centroid clusters.

Every module is one operator with a general interface (DataFrame in,
DataFrame out); ``queries`` registers one query per operator.  Nothing
outside this subpackage imports it.
"""
