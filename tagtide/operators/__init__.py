"""DataFrame to DataFrame operators; pure, lazy unless said otherwise."""
