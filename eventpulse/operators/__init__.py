"""DataFrame-to-DataFrame stages. Row-wise ones accept streams as well."""
