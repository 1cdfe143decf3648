"""Column expressions.  Everything here returns a ``Column`` evaluated inside
the JVM (whole-stage codegen), except ``pvalues`` which holds the one small
Arrow-batched pandas UDF for the Mann-Whitney tail."""
