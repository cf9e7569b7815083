"""DataFrame -> DataFrame operators.  Every per-contract relation is keyed by
(``cod_cli``, ``nmcont``) and every per-account one by (``cod_cli``,
``cod_cad``), so several portfolios can run in one job and equal the union of
one-portfolio runs."""
