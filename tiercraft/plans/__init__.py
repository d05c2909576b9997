"""The tables: how each silver and gold table comes from its inputs."""
