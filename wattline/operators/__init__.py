"""DataFrame-to-DataFrame operators; each works on batch and streaming frames unless it says otherwise."""
