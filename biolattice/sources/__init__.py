"""Readers and writers: delimited tables, variants, genotypes, grids, sequences and trees."""
from .genotypes import (read_genotypes, read_vcf, to_allele_counts, to_genepop,
                        vcf_to_genotypes, write_genepop)
from .grids import read_grid, write_grid
from .sequences import read_fasta, write_fasta
from .tables import read_table, write_table
from .trees import tree_closure, tree_edges

__all__ = ["read_genotypes", "read_vcf", "to_allele_counts", "to_genepop", "vcf_to_genotypes",
           "write_genepop", "read_grid", "write_grid", "read_fasta", "write_fasta", "read_table",
           "write_table", "tree_closure", "tree_edges"]
